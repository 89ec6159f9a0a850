"""Order of documents within a query."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from quillrank.options import RankOptions
from quillrank.workspace import Workspace

PART_BITS = 33  # that monotonically_increasing_id() leaves for the rows of a partition
BEST_FIRST = (F.desc, "score"), (F.asc, "doc_id"), (F.asc, "doc_key")


def best_first() -> list:
    """Higher score first; equal scores by document id."""
    return [order(name) for order, name in BEST_FIRST]


def first_per_query(rows: DataFrame, count: int, order: list, name: str) -> DataFrame:
    """The first ``count`` rows of every query, with their place as ``name``.

    In two steps, first within pieces of a query: many partitions may each send ``count`` rows of one query. The comparison
    with a constant lets Spark cut every partition down to that before the shuffle. A piece is what one partition has of a query,
    so that small partitions are cut as well.
    """
    rows = rows.withColumn("piece", F.spark_partition_id())
    for key in (["query_id", "piece"], ["query_id"]):
        rows = rows.withColumn(name, F.row_number().over(Window.partitionBy(*key).orderBy(*order))).where(F.col(name) <= count)
    return rows.drop("piece")


def top_per_query(scores: DataFrame, count: int) -> DataFrame:
    """The ``count`` best rows of every query, with their ``position``."""
    return first_per_query(scores, count, best_first(), "position")


def ordered_rows(rows: DataFrame, order: list, workspace: Workspace) -> DataFrame:
    """``rows`` in ``order``, written once, with their range partition ``part`` and their number ``row``, which goes up within it."""
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("row", F.monotonically_increasing_id())
    return workspace.save(ordered, "ordered").withColumn("part", F.shiftright("row", PART_BITS))


def numbered(rows: DataFrame, order: list, name: str, workspace: Workspace) -> DataFrame:
    """``rows`` with their place in ``order``, from 1 on, as ``name``; one shuffle, and no single task.

    Rows are range-partitioned and sorted, and written with their number within the partition. A place is that number
    and the rows of the partitions before, of which there is one count each. ``rows`` is read twice, once for the bounds.
    """
    saved = ordered_rows(rows, order, workspace)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = saved.groupBy("part").count().select("part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("before"))
    place = F.col("before") + F.col("row").bitwiseAND(F.lit((1 << PART_BITS) - 1)) + 1
    return saved.join(F.broadcast(parts), "part").withColumn(name, place).drop("part", "row", "before")


def rank_all(scores: DataFrame, options: RankOptions, workspace: Workspace) -> DataFrame:
    """Every row of ``scores``, a written table, with its ``position`` in its query, without one task per query.

    Rows are written once, in order. A query lies in neighbouring range partitions, so its rows there and their first number,
    one row per query and partition, are all that a position needs: the number less the first, and the query's rows in the
    partitions before. Queries and partitions bound these starts; beyond a broadcast they are joined by both, so the rows of
    a hot query come in as many keys as it has partitions.
    """
    saved = ordered_rows(scores, [F.col("query_id"), *best_first()], workspace)
    runs = saved.groupBy("query_id", "part").agg(F.min("row").alias("first"), F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.partitionBy("query_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    starts = runs.select("query_id", "part", (F.col("first") - F.coalesce(before, F.lit(0))).alias("start"))
    measured = workspace.save_measured(starts, "starts")
    starts = F.broadcast(measured.frame) if measured.fits(options.broadcast_bytes) else measured.frame
    return saved.join(starts, ["query_id", "part"]).withColumn("position", F.col("row") - F.col("start") + 1).drop("part", "row", "start")
