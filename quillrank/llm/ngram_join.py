"""N-gram Jaccard join by vertical partitioning.

A document is the set of its word n-grams. All n-grams have one global order, rare before frequent, which is cut into
fragments. How many sets have an n-gram is counted in a table of ``SLOTS`` cells, added up over tasks: n-grams of one cell
count together, so the order is by frequency up to that noise, and total at every size. What a group of near-copies shares
is then no prefix of those that differ in enough unique n-grams, and groups cost in proportion to their size. With n distinct
n-grams a cell holds n / SLOTS others, give or take the square root: groups smaller than that stray are ordered by chance, and
have pairs with the square of that small size at most. Two sets that are alike share one of their rarest n-grams (prefix filter), so candidates come from there; the
overlap of a candidate pair is counted fragment by fragment and summed.

Links are needed up to connection only. First every set is compared with one other set per shared rare n-gram, the centre of
its list; then only pairs are left that share a rare n-gram and are not connected yet. Inside a group of near-copies that is
a number of pairs in proportion to the group. Texts are read again for overlaps, and only sets in candidate pairs are
shuffled. In a large corpus most of the pairs that share a rare n-gram are not alike, as the order is the more by chance the
more n-grams a cell has; so a candidate pair must also be near by its sketches, some bits for an n-gram, which bound the
overlap from above.

Sets are named by a fingerprint of 64 bits of their n-grams' fingerprints. Equal sets have one name, so exact copies are
one set throughout. Defined cases: null and empty texts have an empty set, which links with nothing; rows without an id
have a component of null and lend no id to others; rows of one id are each a document; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from quillrank.llm.bitmap import bitmap, maybe, size_for
from quillrank.llm.components import components
from quillrank.llm.words import cut, mix, run_fingerprints, slices
from quillrank.workspace import Workspace

N = 5
PERCENT = 80
FREQUENT = 1e-5  # share of all n-grams from which one counts as frequent; so there are at most 1 / FREQUENT of them
SLOTS = 1 << 22  # cells of the table of counts
CHUNK = 1 << 16  # cells in a row of it
STEP = 1.03  # ratio of sizes that are joined together
STEPS = 8  # levels per doubling of a count
FRAGMENTS = 4  # of the n-grams that are not frequent; these are a last one
SLICE_BYTES = 1 << 19  # of text at once; shingles take some 100 times that
_BUFFER = 1 << 19
_SEEN = 1 << 20


def shingle_sets(texts: pa.Array, n: int = N) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints of the distinct n-grams, text after text and sorted within, and where each text's begin."""
    words = cut(texts, lower=True)
    prints = words.fingerprints()
    starts, owners = words.run_starts(n)
    grams = run_fingerprints(prints, starts, n)
    counts = words.counts
    for size in range(1, n):  # too short: the whole text is one n-gram
        short = np.flatnonzero(counts == size)
        grams = np.concatenate([grams, run_fingerprints(prints, words.first[short], size)])
        owners = np.concatenate([owners, short])
    order = np.lexsort((grams, owners))
    grams, owners = grams[order], owners[order]
    if len(grams):
        is_new = np.concatenate([[True], (grams[1:] != grams[:-1]) | (owners[1:] != owners[:-1])])
        grams, owners = grams[is_new], owners[is_new]
    return grams, np.searchsorted(owners, np.arange(len(counts) + 1))


def set_names(grams: np.ndarray, first: np.ndarray) -> np.ndarray:
    """A name for each set, the same for the same n-grams."""
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(grams, 11))])
    return mix(sums[first[1:]] - sums[first[:-1]], 12) ^ np.diff(first).astype(np.uint64)


def sketches_of(grams: np.ndarray, first: np.ndarray) -> pa.ListArray:
    """Each set's n-grams counted in cells, of each cell the lowest bit: one to two bits for an n-gram, in a power of two of longs.

    Cells in which two sets differ hold an n-gram that only one of them has, each cell another one.
    """
    sizes = np.diff(first)
    longs = (1 << np.ceil(np.log2(np.maximum(1, -(-sizes // 64)))).astype(np.int64)) * (sizes > 0)
    start = np.concatenate([[0], np.cumsum(longs)])
    cells = (mix(grams, 13) & np.repeat(longs * 64 - 1, sizes).astype(np.uint64)).astype(np.int64) + np.repeat(start[:-1] * 64, sizes)
    odd = (np.bincount(cells, minlength=int(start[-1]) * 64) & 1).astype(np.uint8)
    return pa.ListArray.from_arrays(pa.array(start, pa.int32()), pa.array(np.packbits(odd, bitorder="little").view(np.int64)))


def slots_of(grams: np.ndarray) -> np.ndarray:
    return (grams >> np.uint64(64 - SLOTS.bit_length() + 1)).astype(np.int64)


def add_to(table: np.ndarray, grams: np.ndarray) -> None:
    """Count ``grams`` in their cells, up to the largest number of the table's type."""
    cells, n = np.unique(slots_of(grams), return_counts=True)
    table[cells] = np.minimum(table[cells] + n, np.iinfo(table.dtype).max)


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(chunk, levels)``: the cells of all tasks added up, as levels, from rows in order of ``chunk``."""
    chunk, total = None, None

    def row(chunk, total):
        levels = np.minimum(np.rint(np.log2(total + 1) * STEPS), 255).astype(np.uint8)
        return batch_of(chunk=pa.array([chunk], pa.int32()), levels=pa.array([levels.tobytes()], pa.binary()))

    for batch in batches:
        for at, cells in zip(batch.column("chunk").to_pylist(), batch.column("cells")):
            if at != chunk:
                if chunk is not None:
                    yield row(chunk, total)
                chunk, total = at, np.zeros(CHUNK, np.int64)
            total += np.frombuffer(cells.as_buffer(), np.uint16)
    if chunk is not None:
        yield row(chunk, total)


def levels_of(described: DataFrame) -> np.ndarray:
    """The level of every cell: ``SLOTS`` bytes, however large the corpus."""
    rows = described.where(F.col("chunk").isNotNull()).select("chunk", "cells")
    rows = rows.repartition("chunk").sortWithinPartitions("chunk")
    out = np.zeros(SLOTS, np.uint8)
    for at, levels in zip(*rows.mapInArrow(_summed, "chunk int, levels binary").toArrow().to_pydict().values()):
        out[at * CHUNK : (at + 1) * CHUNK] = np.frombuffer(levels, np.uint8)
    return out


class Counter:
    """Counts of n-grams in bounded memory: when it is full, the rarest are forgotten."""

    def __init__(self, size: int):
        self.size = size
        self.keys, self.counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.waiting: list[np.ndarray] = []
        self.total = 0
        self.n_waiting = 0

    def add(self, grams: np.ndarray) -> None:
        self.waiting.append(grams)
        self.total += len(grams)
        self.n_waiting += len(grams)
        if self.n_waiting >= _BUFFER:
            self.settle()

    def settle(self) -> None:
        fresh, n = np.unique(np.concatenate([np.zeros(0, np.uint64), *self.waiting]), return_counts=True)
        keys, place = np.unique(np.concatenate([self.keys, fresh]), return_inverse=True)
        counts = np.bincount(place, np.concatenate([self.counts, n]), len(keys)).astype(np.int64)
        if len(keys) > self.size:
            keep = np.sort(np.argpartition(counts, -self.size)[-self.size :])
            keys, counts = keys[keep], counts[keep]
        self.keys, self.counts, self.waiting, self.n_waiting = keys, counts, [], 0


def _describe(share: float):
    """One row per document; at a task's end one that lists the n-grams that are frequent in the task, and its cells."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter, unseen, table = Counter(int(2 / share)), Unseen(), np.zeros(SLOTS, np.uint16)
        for batch in slices(batches, size=SLICE_BYTES):
            grams, first = shingle_sets(batch.column("text"))
            names = set_names(grams, first)
            counter.add(grams)
            add_to(table, grams[np.repeat(unseen(names), np.diff(first))])
            sketch = sketches_of(grams, first)
            yield described_rows(len(names), doc_id=batch.column("doc_id"), n=np.diff(first), name=names.view(np.int64), sketch=sketch)
        counter.settle()
        often = counter.counts >= max(2, share * counter.total)
        yield described_rows(1, grams=[counter.keys[often].view(np.int64)], counts=[counter.counts[often]])
        for chunk, cells in enumerate(table.reshape(-1, CHUNK)):
            if cells.any():
                yield described_rows(1, chunk=[chunk], cells=[cells.tobytes()])

    return run


_DESCRIBED = {
    "doc_id": pa.int64(),
    "n": pa.int64(),
    "name": pa.int64(),
    "grams": pa.list_(pa.int64()),
    "counts": pa.list_(pa.int64()),
    "chunk": pa.int32(),
    "cells": pa.binary(),
    "sketch": pa.list_(pa.int64()),
}


def described_rows(rows: int, **columns) -> pa.RecordBatch:
    """A batch of the columns of ``_DESCRIBED``; those not given are null."""
    given = {name: value if isinstance(value, pa.Array) else pa.array(value, _DESCRIBED[name]) for name, value in columns.items()}
    return batch_of(**{name: given.get(name, pa.nulls(rows, kind)) for name, kind in _DESCRIBED.items()})


def batch_of(**columns: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))


class Order:
    """The global order: by the level of an n-gram's cell, then by fingerprint; and which n-grams are frequent."""

    def __init__(self, frequent: np.ndarray, counts: np.ndarray, levels: np.ndarray | None = None):
        self.levels = levels
        by_key = np.argsort(frequent)
        self.frequent = frequent[by_key]
        rank = np.empty(len(frequent), np.int64)
        rank[np.lexsort((frequent, counts))] = np.arange(1, len(frequent) + 1)
        self.rank = rank[by_key]

    def ranks(self, grams: np.ndarray) -> np.ndarray:
        """0 where not frequent, else from 1 on."""
        if not len(self.frequent):
            return np.zeros(len(grams), np.int64)
        at = np.minimum(np.searchsorted(self.frequent, grams), len(self.frequent) - 1)
        return np.where(self.frequent[at] == grams, self.rank[at], 0)

    def level(self, grams: np.ndarray) -> np.ndarray:
        return np.zeros(len(grams), np.uint8) if self.levels is None else self.levels[slots_of(grams)]

    def fragments(self, grams: np.ndarray) -> np.ndarray:
        cell = (grams // np.uint64(-(-(1 << 64) // FRAGMENTS))).astype(np.int64)
        return np.where(self.ranks(grams) > 0, FRAGMENTS, cell)


class Unseen:
    """Which sets a task meets for the first time; beyond a number of them it may say so again."""

    def __init__(self):
        self.names: set[int] = set()

    def __call__(self, names: np.ndarray) -> np.ndarray:
        out = np.ones(len(names), dtype=bool)
        for i, name in enumerate(names.tolist()):
            if name in self.names:
                out[i] = False
            elif len(self.names) < _SEEN:
                self.names.add(name)
        return out


def _prefixes(order: Order):
    """``(gram, name, n, place, is_frequent)`` for the first n-grams of each set and their places in the global order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unseen = Unseen()
        for batch in slices(batches, size=SLICE_BYTES):
            grams, first = shingle_sets(batch.column("text"))
            sizes, names = np.diff(first), set_names(grams, first)
            owners = np.repeat(np.arange(len(sizes)), sizes)
            # Grams are sorted within their set, and the sort is stable.
            by_order = np.argsort((owners << 8) | order.level(grams), kind="stable")
            place = np.arange(len(grams)) - first[owners]
            keep = (place < prefix_length(sizes)[owners]) & unseen(names)[owners]
            own, grams = owners[keep], grams[by_order[keep]]
            yield batch_of(
                gram=pa.array(grams.view(np.int64)),
                name=pa.array(names[own].view(np.int64)),
                n=pa.array(sizes[own], pa.int32()),
                place=pa.array(place[keep], pa.int32()),
                is_frequent=pa.array(order.ranks(grams) > 0),
            )

    return run


def prefix_length(n):
    """A set of ``n`` shares one of so many of its n-grams with every set that is alike."""
    return n - (PERCENT * n + 99) // 100 + 1


def _least_overlap(a: Column, b: Column) -> Column:
    """100 * overlap >= PERCENT * union, as the smallest overlap."""
    return F.ceil(F.lit(PERCENT) * (a + b) / F.lit(100 + PERCENT))


def _may_link(a: Column, b: Column, shared: Column) -> Column:
    """Whether sets of these sizes with ``shared`` common n-grams in their prefixes can be alike.

    All common n-grams up to where the first of the two prefixes ends are in both prefixes; beyond it that set has no more
    than what its prefix leaves.
    """
    rest = F.greatest(a - prefix_length_of(a), b - prefix_length_of(b))
    return (F.least(a, b) * 100 >= F.greatest(a, b) * PERCENT) & (shared + rest >= _least_overlap(a, b))


def prefix_length_of(n: Column) -> Column:
    return n - F.ceil(F.lit(PERCENT) * n / F.lit(100)) + 1


def _segments(order: Order, wanted: np.ndarray):
    """``(name, fragment, grams)`` of the sets that may be ``wanted``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unseen = Unseen()
        for batch in slices(batches, size=SLICE_BYTES):
            grams, first = shingle_sets(batch.column("text"))
            names = set_names(grams, first)
            take = maybe(wanted, names)
            take &= unseen(names) & (np.diff(first) > 0)
            owners = np.repeat(np.arange(len(names)), np.diff(first))
            inside = take[owners]
            grams, owners = grams[inside], owners[inside]
            fragments = order.fragments(grams)
            by_fragment = np.lexsort((grams, fragments, owners))
            grams, key = grams[by_fragment], (owners * (FRAGMENTS + 1) + fragments)[by_fragment]
            keys, start = np.unique(key, return_index=True)
            lists = pa.ListArray.from_arrays(pa.array(np.append(start, len(grams)), pa.int32()), pa.array(grams.view(np.int64)))
            yield batch_of(
                name=pa.array(names[keys // (FRAGMENTS + 1)].view(np.int64)),
                fragment=pa.array(keys % (FRAGMENTS + 1), pa.int32()),
                grams=lists,
            )

    return run


def overlaps(documents: DataFrame, pairs: DataFrame, n_pairs: int, order: Order, workspace: Workspace) -> DataFrame:
    """``pairs`` (``a``, ``b`` and more) with ``overlap``: partial overlaps per fragment, summed.

    Segments are written, so that the join on them may be split where one set is in many pairs.
    """
    names = pairs.select(F.explode(F.array("a", "b")).alias("name"))
    wanted = bitmap(names, F.col("name"), size_for(2 * n_pairs))
    found = documents.select("text").mapInArrow(_segments(order, wanted), "name long, fragment int, grams array<long>")
    segments = workspace.save(found.groupBy("name", "fragment").agg(F.first("grams").alias("grams")), "segments")  # copies are equal
    spread = pairs.withColumn("fragment", F.explode(F.array(*[F.lit(f) for f in range(FRAGMENTS + 1)])))
    left = segments.select(F.col("name").alias("a"), "fragment", F.col("grams").alias("in_a"))
    right = segments.select(F.col("name").alias("b"), "fragment", F.col("grams").alias("in_b"))
    both = spread.join(left, ["a", "fragment"]).join(right, ["b", "fragment"])
    part = F.size(F.array_intersect("in_a", "in_b")).cast("long")
    return both.groupBy(*pairs.columns).agg(F.sum(part).alias("overlap"))


def _differing(a: Column, b: Column) -> Column:
    """In how many cells two sketches differ. The longer one is folded to the length of the other, of half as many longs."""
    size = F.least(F.size(a), F.size(b))

    def folded(sketch: Column) -> Column:
        halves = F.slice(sketch, F.lit(1), size), F.slice(sketch, size + 1, size)
        return F.when(F.size(sketch) > size, F.zip_with(*halves, lambda x, y: x.bitwiseXOR(y))).otherwise(sketch)

    differ = F.zip_with(folded(a), folded(b), lambda x, y: F.bit_count(x.bitwiseXOR(y)))
    return F.coalesce(F.aggregate(differ, F.lit(0), lambda total, x: total + x), F.lit(0))


def _near(pairs: DataFrame, sketches: DataFrame) -> DataFrame:
    """The ``pairs`` that may be alike by their sketches: what differs there at least is not in the overlap."""
    for side in ("a", "b"):
        pairs = pairs.join(sketches.select(F.col("name").alias(side), F.col("sketch").alias(f"in_{side}")), side)
    room = F.col("n_a") + F.col("n_b") - 2 * _least_overlap(F.col("n_a"), F.col("n_b"))
    return pairs.where(_differing(F.col("in_a"), F.col("in_b")) <= room).select("a", "b", "n_a", "n_b")


def _compared(documents: DataFrame, pairs: DataFrame, sketches: DataFrame, order: Order, workspace: Workspace, name: str) -> DataFrame:
    candidates = workspace.save_measured(_near(pairs, sketches), f"{name}-pairs")
    if not candidates.rows:
        return candidates.frame.withColumn("overlap", F.lit(0).cast("long"))
    return workspace.save(overlaps(documents, candidates.frame, candidates.rows, order, workspace), name)


def _linked(compared: DataFrame) -> DataFrame:
    return compared.where(F.col("overlap") >= _least_overlap(F.col("n_a"), F.col("n_b"))).select("a", "b")


def near_duplicates(documents: DataFrame, workspace: Workspace, frequent: float = FREQUENT) -> DataFrame:
    """``(doc_id, n_shingles, component_id)`` per row of ``documents`` (``doc_id``, a whole number, and ``text``).

    Two documents link when their sets' Jaccard similarity is at least ``PERCENT`` in a hundred; ``component_id`` is the
    smallest id that links reach.
    """
    documents = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    schema = "doc_id long, n long, name long, grams array<long>, counts array<long>, chunk int, cells binary, sketch array<long>"
    described = workspace.save(documents.mapInArrow(_describe(frequent), schema), "sets")
    sets = described.where(F.col("n").isNotNull()).select("doc_id", "n", "name")
    total = described.agg(F.sum("n")).first()[0] or 0
    order = frequent_rows(described, frequent * total)
    order.levels = levels_of(described)

    sketches = described.where(F.col("n") > 0).groupBy("name").agg(F.first("sketch").alias("sketch"))  # copies are equal
    sketches = workspace.save(sketches, "sketches")
    lists = _weighted(_shared_prefixes(documents, order, workspace), workspace)
    stars = _compared(documents, _star_pairs(lists, workspace), sketches, order, workspace, "stars")
    known = workspace.save(components(_linked(stars), workspace), "known")
    rest = _compared(documents, _open_pairs(lists, known, workspace), sketches, order, workspace, "open")
    joined = known.select(F.col("node").alias("a"), F.col("component").alias("b")).union(_linked(rest))
    return _labelled(sets, workspace.save(components(joined, workspace), "components"), workspace)


def frequent_rows(described: DataFrame, least: float) -> Order:
    """The order from what tasks counted (``grams``, ``counts``): ``least`` is the count from which one is frequent.

    As a share of all it bounds the number of rows, however large the corpus.
    """
    pairs = described.where(F.col("counts").isNotNull()).select(F.explode(F.arrays_zip("grams", "counts")).alias("g"))
    counted = pairs.groupBy(F.col("g.grams").alias("gram")).agg(F.sum("g.counts").alias("n"))
    rows = counted.where(F.col("n") >= max(2, least)).toArrow()
    return Order(rows.column("gram").to_numpy().view(np.uint64), rows.column("n").to_numpy())


def _shared_prefixes(documents: DataFrame, order: Order, workspace: Workspace) -> DataFrame:
    """``(gram, name, n, place)``: for each rare n-gram the sets that have it, where there are several.

    Frequent n-grams have several sets and need no look; their rows are dealt out evenly.
    """
    rows = documents.select("text").mapInArrow(_prefixes(order), "gram long, name long, n int, place int, is_frequent boolean")
    key = F.when(F.col("is_frequent"), F.xxhash64("gram", "name")).otherwise(F.col("gram"))
    several = F.expr("min(name) over (partition by key) <> max(name) over (partition by key)")
    marked = rows.withColumn("key", key).withColumn("several", several)
    # The key is one of the columns that are made distinct, so rows stay where the shuffle by it has put them.
    kept = marked.where(F.col("is_frequent") | F.col("several")).select("key", "gram", "name", "n", "place").distinct()
    return workspace.save(kept.drop("key"), "lists")


def _weighted(lists: DataFrame, workspace: Workspace) -> DataFrame:
    """``lists`` with a ``weight`` per set: how many others its rare n-grams lead to, on average.

    In a group of near-copies the one that the others come from has the largest: what they changed is rare in them.
    """
    sizes = workspace.save(lists.groupBy("gram").agg(F.count(F.lit(1)).alias("size")), "sizes")
    weights = lists.join(sizes, "gram").groupBy("name", "n").agg((F.sum("size") / prefix_length_of(F.col("n"))).alias("weight"))
    return workspace.save(lists.join(workspace.save(weights.drop("n"), "weights"), "name"), "weighted")


def _star_pairs(lists: DataFrame, workspace: Workspace) -> DataFrame:
    """``(a, b, n_a, n_b)``: every set with the heaviest set of a list it is in."""
    centres = workspace.save(lists.groupBy("gram").agg(F.max(F.struct("weight", "name", "n")).alias("centre")), "centres")
    met = lists.join(centres, "gram").where(F.col("name") != F.col("centre.name"))
    pairs = met.groupBy(F.col("centre.name").alias("a"), F.col("name").alias("b"), F.col("centre.n").alias("n_a"), F.col("n").alias("n_b"))
    shared = pairs.agg(F.count(F.lit(1)).alias("shared"))
    return shared.where(_may_link(F.col("n_a"), F.col("n_b"), F.col("shared"))).drop("shared")


def _open_pairs(lists: DataFrame, known: DataFrame, workspace: Workspace) -> DataFrame:
    """``(a, b, n_a, n_b)``: the pairs that share enough rare n-grams and are not in one component yet.

    In each list the sets outside its largest component are paired with the others of the list, so a list that is nearly all
    connected costs in proportion to its length. How far down a set's order the n-gram stands bounds the overlap, and so the
    size of what the set may link with (``_reach``): a set of many n-grams of its own meets few sets in the lists of
    others. The join is on the n-gram and the larger set's size in steps of ``STEP``, to meet only these. The smaller set has a row for
    each step: fewer sets have room for a larger one than for a smaller one, and where one side is the sets outside the largest
    component, the other is nearly the whole list.
    """
    placed = lists.join(known, lists["name"] == known["node"], "left")
    placed = workspace.save(placed.select("gram", "name", "n", "place", F.coalesce("component", "name").alias("component")), "placed")
    parts = placed.groupBy("gram", "component").agg(F.count(F.lit(1)).alias("size")).groupBy("gram")
    mixed = parts.agg(F.max(F.struct("size", "component")).alias("main"), F.count(F.lit(1)).alias("parts")).where("parts > 1")
    mixed = workspace.save(mixed.select("gram", F.col("main.component").alias("main")), "mixed")
    left = placed.join(mixed, "gram").select("gram", "name", "n", "component", (F.col("component") == F.col("main")).alias("is_main"), _reach().alias("reach"))
    left = workspace.save(left, "left")

    def side(rows: DataFrame, letter: str) -> DataFrame:
        return rows.select("gram", "step", *[F.col(c).alias(f"{c}_{letter}") for c in ("name", "n", "component", "is_main", "reach")])

    most = F.least(F.floor(F.col("n") * 100 / F.lit(PERCENT)), F.col("reach"))
    smaller = side(left.where(F.col("reach") >= F.col("n")).withColumn("step", F.explode(F.sequence(_step(F.col("n")), _step(most)))), "a")
    least = F.ceil(F.lit(PERCENT) * F.col("n") / F.lit(100))
    larger = side(left.where(least <= F.least("n", "reach")).withColumn("step", _step(F.col("n"))), "b")
    fits = (F.col("n_b") <= F.col("reach_a")) & (F.col("n_a") <= F.col("reach_b")) & (F.col("n_a") * 100 >= F.col("n_b") * PERCENT)
    once = F.struct("n_a", "name_a") < F.struct("n_b", "name_b")
    open_ = fits & once & (F.col("component_a") != F.col("component_b"))
    keys = ["gram", "step"]
    met = smaller.where(~F.col("is_main_a")).join(larger, keys).where(open_)
    met = met.unionByName(smaller.where("is_main_a").join(larger.where(~F.col("is_main_b")), keys).where(open_))
    # What they share after the first n-gram may be out of reach, so nothing is counted here.
    return met.select(F.col("name_a").alias("a"), F.col("name_b").alias("b"), "n_a", "n_b").distinct()


def _reach() -> Column:
    """The size of the largest set that a set of ``n`` may link with if the first n-gram that they share is at ``place``."""
    return F.floor((F.col("n") - F.col("place")) * (100 + PERCENT) / F.lit(PERCENT)) - F.col("n")


def _step(n: Column) -> Column:
    return F.floor(F.log(n.cast("double")) / F.lit(np.log(STEP).item())).cast("int")


def _labelled(sets: DataFrame, known: DataFrame, workspace: Workspace) -> DataFrame:
    grouped = sets.join(known, (sets["name"] == known["node"]) & (sets["n"] > 0), "left").select(
        "doc_id", "n", F.when(F.col("n") > 0, F.coalesce("component", "name")).alias("component")
    )
    smallest = grouped.where(F.col("component").isNotNull()).groupBy("component").agg(F.min("doc_id").alias("smallest"))
    smallest = workspace.save(smallest, "smallest")
    # An empty set is alone; it gets a key that no component has and each document its own.
    return grouped.join(smallest, "component", "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("doc_id").isNotNull(), F.coalesce("smallest", "doc_id")).alias("component_id"),
    )


def representatives(documents: DataFrame, found: DataFrame) -> DataFrame:
    """One row of ``documents`` per component of ``near_duplicates``, with all columns: that with the smallest id.

    Equal rows of that id are one; rows without an id stay.
    """
    gone = found.where(F.col("doc_id") != F.col("component_id")).select("doc_id").distinct()
    return documents.join(gone, "doc_id", "left_anti").dropDuplicates(["doc_id", "text"])
