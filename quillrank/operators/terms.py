"""Query terms, and the dictionary from tokens to query terms."""

from __future__ import annotations

from math import ceil

from pyspark.sql import Column, DataFrame, functions as F

from quillrank.functions.porter import stem
from quillrank.functions.text import tokenize
from quillrank.options import RankOptions
from quillrank.workspace import Workspace

# Every document carries the empty token, which no text yields, and the dictionary maps it to the empty
# term. So a document without any query term is still there after the join, to be counted.
PRESENT = ""
STEMS = "token string, stem1 string, again string"  # a kept stem table; ``again`` is the stem of ``stem1``
STEM_ROWS = 1 << 20  # rows of one of its files


def query_tokens(queries: DataFrame, options: RankOptions) -> DataFrame:
    return queries.select("query_id", tokenize(F.col("query"), options.rules, options.stopwords).alias("tokens"))


def query_terms(queries: DataFrame, options: RankOptions) -> DataFrame:
    """``(query_id, pos, term, n_terms)``, repeated terms kept. A query without terms has no row."""
    return token_terms(query_tokens(queries, options), options)


def token_terms(tokens: DataFrame, options: RankOptions) -> DataFrame:
    """``query_terms`` from ``(query_id, tokens)``."""
    terms = tokens.select("query_id", F.posexplode("tokens").alias("pos", "term"), F.size("tokens").alias("n_terms"))
    if options.stem:
        terms = terms.withColumn("term", stem("term"))
    return terms.select("query_id", "pos", "term", "n_terms")


def vocabulary(documents: DataFrame) -> DataFrame:
    """``(token)``: the distinct tokens of the corpus, made distinct before the shuffle as well."""
    return documents.select(F.explode(F.concat("title_tokens", "body_tokens")).alias("token")).distinct()


def _stems(tokens: DataFrame) -> DataFrame:
    return tokens.select("token", stem("token").alias("stem1")).select("token", "stem1", stem("stem1").alias("again"))


def _second(options: RankOptions) -> Column:
    return F.when(~F.col("stem1").isin(list(options.stopwords)), F.col("again"))


def stem_vocabulary(tokens: DataFrame, options: RankOptions) -> DataFrame:
    """``(token, stem1, stem2)`` for every row of ``tokens``.

    ``stem2`` is what a second analysis makes of ``stem1``: null where that is a stopword, else its stem.
    """
    return _stems(tokens).select("token", "stem1", _second(options).alias("stem2"))


def kept_stem_vocabulary(tokens: DataFrame, path: str, options: RankOptions, workspace: Workspace) -> DataFrame:
    """``stem_vocabulary`` of the distinct ``tokens`` with a table of stems at ``path`` that grows over runs.

    Only tokens that the table lacks are stemmed, and then appended to it. It does not depend on options. A run that is cut off
    while appending leaves right rows behind, and two runs at once may append a token twice, so a token counts once
    when the table is read.
    """
    spark = tokens.sparkSession
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(folder)

    def table() -> DataFrame:
        return spark.read.schema(STEMS).parquet(path)

    tokens = workspace.save(tokens, "vocabulary")
    new = workspace.save_measured(_stems(tokens.join(table(), "token", "left_anti")), "stems")
    if new.rows:
        new.frame.repartition(ceil(new.rows / STEM_ROWS)).write.mode("append").parquet(path)
    kept = table().dropDuplicates(["token"])
    return tokens.join(kept, "token").select("token", "stem1", _second(options).alias("stem2"))


def plain_dictionary(terms: DataFrame) -> DataFrame:
    """``(token, term)`` where tokens are not stemmed: every query term stands for itself."""
    present = terms.sparkSession.range(1).select(F.lit(PRESENT).alias("term"))
    return terms.select("term").union(present).distinct().select(F.col("term").alias("token"), "term")


def stemmed_dictionary(vocabulary: DataFrame, terms: DataFrame, options: RankOptions) -> DataFrame:
    """``(token, term)`` for the tokens that stem to a query term.

    With two body passes ``(token, in_body, term)``, as title and body then stem differently.
    """
    wanted = terms.select("term").distinct()
    once = vocabulary.select("token", F.lit(False).alias("in_body"), F.col("stem1").alias("term"))
    present = terms.sparkSession.range(1).select(
        F.lit(PRESENT).alias("token"), F.lit(False).alias("in_body"), F.lit(PRESENT).alias("term")
    )
    if options.body_passes == 1:
        return once.join(wanted, "term", "left_semi").select("token", "term").union(present.select("token", "term"))
    forms = vocabulary.select(
        "token",
        F.explode(
            F.array(
                F.struct(F.lit(False).alias("in_body"), F.col("stem1").alias("term")),
                F.struct(F.lit(True).alias("in_body"), F.col("stem2").alias("term")),
            )
        ).alias("form"),
    ).select("token", "form.*")
    return forms.join(wanted, "term", "left_semi").select("token", "in_body", "term").union(present)
