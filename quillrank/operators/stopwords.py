"""Stop words from a table, which may have any size: nothing of it goes through the driver or into a plan."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from quillrank.operators.lookup import lookup_join
from quillrank.options import RankOptions
from quillrank.workspace import Workspace


def read_words(spark: SparkSession, path: str) -> DataFrame:
    """``(token)``: the distinct lines of a text path; empty ones are left out."""
    return spark.read.text(path).select(F.col("value").alias("token")).where("token != ''").distinct()


def without_words(rows: DataFrame, key: str, columns: list[str], words: DataFrame, options: RankOptions, workspace: Workspace) -> DataFrame:
    """``rows``, a written table, with the tokens in ``words`` taken out of the arrays ``columns``, none of them null; others keep their order.

    ``key`` is different in every row and never null. The list is met by distinct tokens only. What of it occurs is measured: if it may be
    broadcast, tokens are dropped where they are, else the tokens that stay are looked up, hot ones apart. The places of those that
    stay then come back to their row by ``key``, so no task holds more than rows did before. Without any such token the rows are returned as they are.
    """
    def entries(part: int, column: str):
        return F.transform(column, lambda token, pos: F.struct(F.lit(part).alias("part"), pos.alias("pos"), token.alias("token")))

    places = rows.select(key, F.explode(F.concat(*[entries(*pair) for pair in enumerate(columns)])).alias("entry")).select(key, "entry.*")
    vocabulary = workspace.save(places.select("token").distinct(), "vocabulary")
    listed = workspace.save_measured(vocabulary.join(words, "token", "left_semi"), "listed")
    if not listed.rows:
        return rows
    if listed.fits(options.broadcast_bytes):
        kept = places.join(F.broadcast(listed.frame), "token", "left_anti")
    else:
        staying = vocabulary.join(listed.frame, "token", "left_anti")
        kept = lookup_join(workspace.save(places, "places"), staying, ["token"], False, workspace, options.broadcast_bytes)
    # Places only, as the row has the tokens.
    of_part = [F.array_sort(F.collect_list(F.when(F.col("part") == part, F.col("pos")))).alias(f"kept_{part}") for part in range(len(columns))]
    joined = rows.join(kept.groupBy(key).agg(*of_part), key, "left")

    def tokens(column: str):
        stays = F.transform(f"kept_{columns.index(column)}", lambda pos: F.get(column, pos))
        return F.coalesce(stays, F.array().cast("array<string>")).alias(column)

    return joined.select(*[tokens(name) if name in columns else name for name in rows.columns])


def without_listed_stems(stems: DataFrame, words: DataFrame) -> DataFrame:
    """``(token, stem1, stem2)`` with null for ``stem2`` where ``stem1`` is in ``words``."""
    flagged = stems.join(words.select(F.col("token").alias("stem1"), F.lit(True).alias("listed")), "stem1", "left")
    return flagged.select("token", "stem1", F.when(F.col("listed").isNull(), F.col("stem2")).alias("stem2"))
