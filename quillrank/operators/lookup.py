"""Joining a large table to a lookup table that is usually, but not provably, small."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from quillrank.workspace import Workspace

COUNTERS = 1 << 14  # keys that a task counts at a time; whatever has more than rows / COUNTERS of the rows is among them
HOT_KEYS = 1000  # at most so many keys can have more than this part of the rows
SHARE = 4  # a key is hot if it has more than a fourth of what an even partition has


def hot_keys(facts: DataFrame, key: str) -> DataFrame:
    """``(key)``: the heavy hitters of ``facts``, found by bounded counters in the tasks; at most ``HOT_KEYS`` rows."""
    pieces = int(facts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    top = facts.agg(F.expr(f"approx_top_k({key}, {HOT_KEYS}, {COUNTERS})").alias("top"), F.count(F.lit(1)).alias("rows"))
    counted = top.select("rows", F.explode("top").alias("entry"))
    return counted.where(F.col("entry.count") * (SHARE * pieces) > F.col("rows")).select(F.col("entry.item").alias(key))


def lookup_join(
    facts: DataFrame, lookup: DataFrame, on: list[str], small: bool, workspace: Workspace | None = None, limit: int = 0
) -> DataFrame:
    """Inner equi-join; ``small`` says that the measured lookup side may be broadcast.

    Otherwise, the rows of hot keys stay where they are: their part of ``lookup`` is broadcast, and only the rest is shuffled by
    the key. If not even that part fits into ``limit`` bytes, all rows are shuffled and adaptive execution splits the hot
    keys, which it can as both sides are written tables (an aggregate below the join would keep it from that). ``facts``
    is read three times, so it should be a written table.
    """
    if small:
        return facts.join(F.broadcast(lookup), on)
    lookup = workspace.save(lookup, "lookup")
    keys = F.broadcast(workspace.save(hot_keys(facts, on[0]), "hot-keys"))
    hot = workspace.save_measured(lookup.join(keys, on[0], "left_semi"), "hot")
    if not hot.fits(limit):
        return facts.join(lookup, on)
    rest = facts.join(keys, on[0], "left_anti").join(lookup.join(keys, on[0], "left_anti"), on)
    return facts.join(F.broadcast(hot.frame), on).unionByName(rest)
