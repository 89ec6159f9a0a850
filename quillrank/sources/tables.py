"""The sample tables in the shape of articles and queries.

``documents`` has no title and no content items. The first of several lines is taken as the title, the
others are content items; a single line is a body without a title. Lines that end in a full stop are
paragraphs, spelled in capitals where they hold a comma; other lines have no subtype.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from quillrank.sources.articles import ARTICLE, RANKED_FIELDS


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def articles_from_documents(documents: DataFrame, schema: T.StructType = ARTICLE) -> DataFrame:
    """Articles with the fields of ``schema``; ``id`` keeps its type."""
    lines = documents.select("doc_id", "source", F.split("text", "\n").alias("lines"))
    several = F.size("lines") > 1
    # Titles are reduced to ASCII, so that engines that count bytes and engines that count characters
    # measure the same edit distance.
    title = F.when(several, F.regexp_replace(F.col("lines")[0], "[^ -~]", "?"))
    body = F.when(several, F.slice("lines", 2, F.greatest(F.size("lines") - 1, F.lit(1)))).otherwise(F.col("lines"))

    item_fields = schema["contents"].dataType.elementType.names

    def item(line):
        subtype = F.when(line.endswith("."), F.when(line.contains(","), F.lit("PARAGRAPH")).otherwise(F.lit("paragraph")))
        fixed = {
            "content": line,
            "subtype": subtype,
            "type": F.lit("sanitized_html"),
            "mime": F.lit("text/html"),
        }
        return F.struct(
            *[fixed.get(name, F.lit(None).cast("string")).alias(name) for name in item_fields]
        )

    fields = {
        "id": F.col("doc_id"),
        "article_url": F.concat(F.lit("https://example.org/"), F.col("doc_id")),
        "title": title,
        "author": F.lit(None).cast("string"),
        "published_date": F.lit(1577836800000) + F.col("doc_id") * 60000,
        "contents": F.transform(body, item),
        "type": F.lit("article"),
        "source": F.col("source"),
    }
    return lines.select(*[fields[name].alias(name) for name in schema.names])


def queries_from_benchmark(benchmark: DataFrame) -> DataFrame:
    """Every benchmark passage, as a whole, is a query."""
    return benchmark.select(
        F.col("item_id").alias("query_id"), F.trim(F.regexp_replace("text", r"\s+", " ")).alias("query")
    )


def sample_articles(spark: SparkSession, folder: str, schema: T.StructType = RANKED_FIELDS) -> DataFrame:
    documents = read_table(spark, folder, "documents").select("doc_id", "source", "text")
    return articles_from_documents(documents, schema)


def sample_queries(spark: SparkSession, folder: str) -> DataFrame:
    return queries_from_benchmark(read_table(spark, folder, "benchmark"))
