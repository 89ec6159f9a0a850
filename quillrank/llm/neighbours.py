"""Nearest neighbours by cosine with vantage-point trees, one per shard.

Normalised vectors have distances for which the triangle inequality holds, and the nearest by distance is the nearest by
cosine. A query goes down the side of a vantage point it is on and visits the other side only if that may hold something
nearer: if its distance to the border, times ``factor``, is below the k-th distance so far. A factor of one restores
exact search; larger ones prune more. Shards have a bounded number of vectors and queries come in bounded blocks, so a task
holds one shard and one block.

Defined cases: a vector that is null, empty, zero or holds a null or non-finite component takes no part, nor does a row
without an id; vectors of another length than a query's are no candidates for it; equal rows count once, and an id with
several vectors is found by its best one and asks with the smallest one; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

K = 5
FACTOR = 1.0
SHARD_ROWS = 8192
BLOCK_ROWS = 4096
LEAF = 64
_SLACK = 1e-9  # on squared distances, for what rounding does to them
_SPARE = 16


class Tree:
    """Points in the order of the tree's leaves; inner nodes split a range at the median distance to its first point."""

    def __init__(self, points: np.ndarray):
        self.order = np.arange(len(points))
        self.nodes: list[tuple] = []
        self.points = points
        if len(points):
            self._build(0, len(points))
        self.points = points[self.order]

    def _build(self, low: int, high: int) -> int:
        at = len(self.nodes)
        self.nodes.append((low, high, 0.0, -1, -1))
        if high - low > LEAF:
            inside = self.order[low + 1 : high]
            distance = np.linalg.norm(self.points[inside] - self.points[self.order[low]], axis=1)
            middle = len(inside) // 2
            split = np.argpartition(distance, middle)
            self.order[low + 1 : high] = inside[split]
            border = float(distance[split[middle]])  # inside: at most that far; outside: at least
            self.nodes[at] = (low, high, border, self._build(low + 1, low + 1 + middle), self._build(low + 1 + middle, high))
        return at

    def nearest(self, queries: np.ndarray, k: int, factor: float) -> tuple[np.ndarray, np.ndarray]:
        """Squared distances and places in ``order`` of the ``k`` nearest found for each query, unordered."""
        best = np.full((len(queries), k), np.inf)
        place = np.full((len(queries), k), -1)
        if self.nodes:
            self._visit(0, np.arange(len(queries)), queries, best, place, factor)
        return best, place

    def _offer(self, low: int, high: int, asking: np.ndarray, queries: np.ndarray, best: np.ndarray, place: np.ndarray) -> np.ndarray:
        squared = np.maximum(2.0 - 2.0 * (queries[asking] @ self.points[low:high].T), 0.0)
        k = best.shape[1]
        near = squared.min(axis=1) < best[asking].max(axis=1)
        if near.any():
            rows = asking[near]
            all_best = np.concatenate([best[rows], squared[near]], axis=1)
            span = np.broadcast_to(np.arange(low, high), (len(rows), high - low))
            all_place = np.concatenate([place[rows], span], axis=1)
            keep = np.argpartition(all_best, k - 1, axis=1)[:, :k]
            best[rows] = np.take_along_axis(all_best, keep, axis=1)
            place[rows] = np.take_along_axis(all_place, keep, axis=1)
        return squared

    def _visit(self, node: int, asking: np.ndarray, queries: np.ndarray, best: np.ndarray, place: np.ndarray, factor: float) -> None:
        if not len(asking):
            return
        low, high, border, inner, outer = self.nodes[node]
        if inner < 0:
            self._offer(low, high, asking, queries, best, place)
            return
        distance = np.sqrt(self._offer(low, low + 1, asking, queries, best, place)[:, 0])
        is_in = distance < border
        self._visit(inner, asking[is_in], queries, best, place, factor)
        self._visit(outer, asking[~is_in], queries, best, place, factor)
        far = np.abs(distance - border) * factor <= np.sqrt(best[asking].max(axis=1)) + _SLACK**0.5
        self._visit(outer, asking[is_in & far], queries, best, place, factor)
        self._visit(inner, asking[~is_in & far], queries, best, place, factor)


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosine of each pair of rows; sums run from the first component to the last."""
    dot, left, right = (np.zeros(len(a)) for _ in range(3))
    for i in range(a.shape[1]):
        dot += a[:, i] * b[:, i]
        left += a[:, i] * a[:, i]
        right += b[:, i] * b[:, i]
    return dot / (np.sqrt(left) * np.sqrt(right))


def search_shard(ids: np.ndarray, vectors: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, k: int, factor: float) -> pd.DataFrame:
    """The ``k`` nearest of a shard for each query, by exact cosine, ties to the smaller id."""
    order = np.lexsort((ids, *vectors.T[::-1]))
    ids, vectors = ids[order], vectors[order]
    is_new = np.ones(len(ids), dtype=bool)
    is_new[1:] = (vectors[1:] != vectors[:-1]).any(axis=1)
    first = np.flatnonzero(is_new)
    # Equal vectors are one point; of their ids the smallest are enough, one more as a query leaves out itself.
    sizes = np.minimum(np.diff(np.append(first, len(ids))), k + 1)
    points = vectors[first]
    unit = points / np.linalg.norm(points, axis=1, keepdims=True)
    asked = queries / np.linalg.norm(queries, axis=1, keepdims=True)
    tree = Tree(unit)
    wanted = k + 1 + _SPARE  # itself, and some for vectors whose distances rounding cannot tell apart
    best, place = tree.nearest(asked, wanted, factor)
    found = np.where(place >= 0, tree.order[place], -1)
    # Where even the last one found could tie with the k-th, all points are candidates.
    ranked = np.sort(best, axis=1)
    unclear = (place >= 0).all(axis=1) & (ranked[:, -1] <= ranked[:, k] + _SLACK)
    row, column = np.nonzero((found >= 0) & ~unclear[:, None])
    pairs = [(row, found[row, column])] + [(np.full(len(points), q), np.arange(len(points))) for q in np.flatnonzero(unclear)]
    out = []
    for query, point in pairs:
        score = cosines(queries[query], points[point])
        count = sizes[point]
        at = np.arange(count.sum()) + np.repeat(first[point] - (np.cumsum(count) - count), count)
        hit = pd.DataFrame({"query_id": np.repeat(query_ids[query], count), "vec_id": ids[at], "score": np.repeat(score, count)})
        hit = hit[hit["query_id"] != hit["vec_id"]].sort_values(["query_id", "score", "vec_id"], ascending=[True, False, True])
        out.append(hit.drop_duplicates(["query_id", "vec_id"]).groupby("query_id").head(k))
    return pd.concat(out) if out else pd.DataFrame({"query_id": [], "vec_id": [], "score": []})


def usable(vectors: DataFrame) -> DataFrame:
    """``(vec_id, vector, dim)`` of the rows that take part, in double precision, each once.

    Equal rows go before shards are cut: however often a row is repeated, it is one of a shard's rows and one of the
    places among equal vectors.
    """
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    frame = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("vector"))
    frame = frame.where(F.col("vec_id").isNotNull() & F.col("vector").isNotNull()).where(finite)
    # Vectors that differ in the sign of a zero only are equal.
    frame = frame.where(F.exists("vector", lambda x: x != 0)).withColumn("vector", F.transform("vector", lambda x: x + F.lit(0.0)))
    return frame.distinct().withColumn("dim", F.size("vector"))


def nearest(vectors: DataFrame, is_query: Column, k: int = K, factor: float = FACTOR, shard_rows: int = SHARD_ROWS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the ``k`` nearest rows found for each row of ``vectors`` with ``is_query``.

    ``vectors`` has ``vec_id`` and ``embedding``. Every block of queries meets every shard.
    """
    known = usable(vectors)
    asked = known.where(is_query).groupBy("vec_id").agg(F.min("vector").alias("vector")).withColumn("dim", F.size("vector"))
    counts = known.agg(F.count(F.lit(1)).alias("n"), F.count_if(is_query).alias("asked")).first()
    shards, blocks = max(1, -(-counts["n"] // shard_rows)), max(1, -(-counts["asked"] // block_rows))
    every = lambda n, name: F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias(name)
    stored = known.select("*", F.pmod(F.xxhash64("vec_id"), F.lit(shards)).cast("int").alias("shard")).select("*", every(blocks, "block"))
    asking = asked.select("*", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int").alias("block")).select("*", every(shards, "shard"))

    def search(stored: pd.DataFrame, asking: pd.DataFrame) -> pd.DataFrame:
        if stored.empty or asking.empty:
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        return search_shard(
            stored["vec_id"].to_numpy(), np.stack(stored["vector"]), asking["vec_id"].to_numpy(), np.stack(asking["vector"]), k, factor
        )

    keys = ["dim", "shard", "block"]
    found = stored.groupBy(keys).cogroup(asking.groupBy(keys)).applyInPandas(search, "query_id long, vec_id long, score double")
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
