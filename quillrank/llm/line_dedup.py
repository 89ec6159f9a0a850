"""Line dedup: a suffix array over the sequences of line ids, by distributed prefix doubling.

A suffix is what follows from a line to the end of its text. In round k suffixes are ranked by their first 2^k lines: the
rank of the first half and that of the second, found 2^(k-1) lines on, are a pair, and pairs are numbered in order. After
``log2(min_lines)`` rounds suffixes of one rank are the intervals whose longest common prefix has ``min_lines`` lines or
more. Sorting deeper would cut them finer and find no other repeats: longer runs are neighbouring ones of that length,
which are joined to maximal runs. Suffixes whose rank is theirs alone leave in every round. Only built-in expressions.

A run also qualifies by its size: one of fewer lines, but with ``long_words`` words or more in all. For that, ranks of every
depth below ``min_lines`` are looked at, of suffixes whose first lines have so many words; the depth then grows by one
line a round instead of doubling. With two lines both are one round.

Texts come in the order of their ids. In an interval the first suffix stays; the lines of the run in all others are
later copies and are deleted. Defined cases: a null text has no lines, an empty one has one empty line; rows without an id come
last; rows of one id in the order in which they are read, so of repeated rows one stays; further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from quillrank.operators.ranking import numbered
from quillrank.workspace import Workspace

MIN_LINES = 2  # of a repeated run; a power of two
LONG_WORDS = 50  # or its words, however few its lines; None: lines alone count
WORD = r"[^\x20\x09-\x0D]+"


def _ranked(suffixes: DataFrame, keys: list[str], workspace: Workspace) -> DataFrame:
    """``suffixes`` with ``rank`` instead of ``keys``, without those whose keys no other has.

    Keys are counted before they are shuffled, and numbered by range partitions, so a line that is everywhere is one row
    here; the join on it is split where it is hot.
    """
    several = suffixes.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1).drop("n")
    ranks = numbered(several, [F.col(key) for key in keys], "new_rank", workspace)
    joined = suffixes.join(ranks, keys).select("row", "place", "line", "words", F.col("new_rank").alias("rank"))
    return workspace.save(joined, "ranks")


def _copies(suffixes: DataFrame, depth: int) -> DataFrame:
    """``(row, line, depth)``: the suffixes of each rank but the first."""
    first = suffixes.groupBy("rank").agg(F.min(F.struct("place", "row", "line")).alias("first"))
    copies = suffixes.join(first, "rank").where(F.struct("place", "row", "line") != F.col("first"))
    return copies.select("row", "line", F.lit(depth).alias("depth"))


def repeated_runs(lines: DataFrame, workspace: Workspace, min_lines: int = MIN_LINES, long_words: int | None = LONG_WORDS) -> DataFrame:
    """``(row, start, end)``: the maximal runs of lines to delete, from ``lines`` (``row``, ``place``, ``line``, ``words``, ``id``).

    ``place`` orders the texts, ``row`` names them, ``line`` counts from 0, ``words`` are those of the line.
    """
    if min_lines < 1 or min_lines & (min_lines - 1):
        raise ValueError("min_lines must be a power of two")
    singles = suffixes = _ranked(lines, ["id"], workspace)
    depth, copies = 1, None
    while depth < min_lines:
        if long_words is not None:
            long = _copies(suffixes.where(F.col("words") >= long_words), depth)
            copies = long if copies is None else copies.union(long)
        ahead, step = (suffixes, depth) if long_words is None else (singles, 1)
        following = ahead.select("row", (F.col("line") - depth).alias("line"), F.col("rank").alias("next"), F.col("words").alias("more"))
        joined = suffixes.join(following, ["row", "line"]).withColumn("words", F.col("words") + F.col("more"))
        suffixes, depth = _ranked(joined, ["rank", "next"], workspace), depth + step
    copies = _copies(suffixes, depth) if copies is None else copies.union(_copies(suffixes, depth))
    deleted = copies.select("row", F.explode(F.sequence(F.col("line"), F.col("line") + F.col("depth") - 1)).alias("line")).distinct()
    # A run begins where the line before is not deleted; its number is how many have begun.
    order = Window.partitionBy("row").orderBy("line")
    begins = F.coalesce(F.col("line") - F.lag("line").over(order) > 1, F.lit(True))
    runs = deleted.withColumn("begins", begins).withColumn("run", F.sum(F.col("begins").cast("int")).over(order))
    return runs.groupBy("row", "run").agg(F.min("line").alias("start"), (F.max("line") + 1).alias("end")).drop("run")


def without_repeats(
    documents: DataFrame, workspace: Workspace, min_lines: int = MIN_LINES, long_words: int | None = LONG_WORDS
) -> DataFrame:
    """``(doc_id, text, n_lines, removed)`` per row of ``documents`` (``doc_id``, ``text``), ``text`` without later copies.

    ``removed`` are the deleted runs as ``[start, end)`` of the lines of the input.
    """
    # Written with a name for each row, by which the runs come back.
    known = workspace.save(documents.select("doc_id", "text").withColumn("row", F.monotonically_increasing_id()), "texts")
    split = F.split("text", "\n", -1)
    place = F.coalesce(F.col("doc_id").cast("long"), F.lit((1 << 63) - 1))
    lines = known.where(F.col("text").isNotNull()).select("row", place.alias("place"), F.posexplode(split).alias("line", "content"))
    words = F.lit(0) if long_words is None else F.regexp_count("content", F.lit(WORD))
    lines = workspace.save(lines.select("row", "place", "line", words.alias("words"), F.xxhash64("content").alias("id")), "lines")
    runs = repeated_runs(lines, workspace, min_lines, long_words)
    by_row = runs.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("removed"))
    joined = known.join(by_row, "row", "left")
    n_lines = F.when(F.col("text").isNull(), 0).otherwise(F.size(split)).cast("long")
    none = F.array().cast("array<struct<start:int,end:int>>")
    return joined.select(
        "doc_id",
        F.when(F.col("removed").isNull(), F.col("text")).otherwise(F.array_join(_kept(split, F.col("removed")), "\n")).alias("text"),
        n_lines.alias("n_lines"),
        F.coalesce("removed", none).alias("removed"),
    )


def _kept(lines: Column, removed: Column) -> Column:
    """The lines between the runs."""
    low = F.concat(F.array(F.lit(0)), F.transform(removed, lambda run: run["end"]))
    high = F.concat(F.transform(removed, lambda run: run["start"]), F.array(F.size(lines)))
    return F.flatten(F.zip_with(low, high, lambda a, b: F.slice(lines, a + 1, b - a)))


def n_removed() -> Column:
    return F.aggregate("removed", F.lit(0).cast("long"), lambda n, run: n + run["end"] - run["start"])
