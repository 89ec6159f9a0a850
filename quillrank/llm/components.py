"""Connected components, for links that no single task could hold."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from quillrank.workspace import Workspace


def components(links: DataFrame, workspace: Workspace) -> DataFrame:
    """``(node, component)`` for every node of ``links`` (``a``, ``b``): the smallest node that links reach.

    Large-star and small-star steps in turn (Kiveris et al.): every node hangs its larger neighbours, and then its smaller
    ones, under its smallest neighbour, until nothing changes. Neighbours of one node are never gathered: the smallest
    one is an aggregate that is begun before the shuffle, and it is written, as the join on it may be split where a node has
    many neighbours only if no aggregate lies right below.
    """
    edges = links.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    found = workspace.save_measured(edges.distinct(), "links")
    edges, before = found.frame, None
    while found.rows:
        both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = workspace.save(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "least")
        large = both.where(F.col("v") > F.col("u")).join(least, "u").where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = workspace.save(large.distinct(), "large")
        least = workspace.save(large.groupBy("u").agg(F.min("v").alias("m")), "least")
        small = large.join(least, "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
        saved = workspace.save_measured(
            small.where(F.col("u") != F.col("v")).distinct(), "small", mark=F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
        )
        edges, now = saved.frame, (saved.rows, saved.observed["mark"])
        if now == before:
            break
        before = now
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)
