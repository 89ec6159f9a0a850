"""Rankings as nested rows, as text lines and as files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def file_name(query: Column) -> Column:
    return F.translate(query, " ", "_")


def nested(ranking: DataFrame) -> DataFrame:
    """``(query_id, query, results)``, results in rank order."""
    results = F.array_sort(F.collect_list(F.struct("rank", "doc_id", "score", "title")))
    return ranking.groupBy("query_id", "query").agg(results.alias("results"))


def report_lines(ranking: DataFrame) -> DataFrame:
    """``(query_id, query, line_no, line)``: the query, then one indented line per document."""
    result = F.concat(
        F.lit("  "), F.col("rank"), F.lit(":"), F.col("doc_id"), F.lit(" "), F.col("score"), F.lit(" "),
        F.coalesce("title", F.lit("null")),
    )
    lines = ranking.select("query_id", "query", F.col("rank").alias("line_no"), result.alias("line"))
    heads = ranking.where(F.col("rank") == 1).select(
        "query_id", "query", F.lit(0).alias("line_no"), F.col("query").alias("line")
    )
    return heads.union(lines)


def write_report(ranking: DataFrame, path: str) -> None:
    """One folder per query with one text file, lines in rank order, and ``_SUCCESS`` when all are there.

    Folders are named by the query id. ``manifest`` beside ``reports`` holds ``(query_id, file_name, query)``, a query of
    any length. A query has at most k + 1 lines.
    """
    lines = report_lines(ranking).select("query_id", "line_no", F.col("line").alias("value"))
    (
        lines.repartition("query_id")
        .sortWithinPartitions("query_id", "line_no")
        .select("query_id", "value")
        .write.partitionBy("query_id")
        .text(f"{path}/reports")
    )
    asked = ranking.where(F.col("rank") == 1).select("query_id", file_name(F.col("query")).alias("file_name"), "query")
    asked.write.parquet(f"{path}/manifest")


def read_report(spark: SparkSession, path: str) -> DataFrame:
    """``(query_id, line_no, line)`` of the files that ``write_report`` has written. Each is read by one task."""
    files = spark.read.text(f"{path}/reports", wholetext=True).select("query_id", F.split("value", "\n").alias("lines"))
    lines = files.select("query_id", F.posexplode(F.slice("lines", 1, F.size("lines") - 1)).alias("line_no", "line"))
    return lines.select("query_id", "line_no", "line")


def write_ranking(ranking: DataFrame, path: str) -> None:
    ranking.write.parquet(path)
