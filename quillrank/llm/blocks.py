"""Corpus-wide values for the keys of rows, where rows have far more keys than there are different ones.

The tasks that read rows cut them into blocks of ``BLOCK_BYTES`` of text, or of fewer where that has ``BLOCK_KEYS`` distinct
keys, and list the distinct keys of each block once, with how often they occur. These lists are summed over the corpus, and the values made from the sums come back to each block that
has the key. There its rows meet them in a stream: first the keys of a block, then its rows, so that a task holds the
distinct keys of one block and one batch of rows. No table of all keys is ever in one place.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

BLOCK_BYTES = 64 << 20
BLOCK_KEYS = 1 << 22  # distinct keys of all kinds that end a block, whatever its bytes
LISTED = 1 << 16  # keys in a row of a list
_BITS = 24  # of a block's number within its task
_MERGE = 1 << 19  # keys that wait to be merged
PACKED = 1 << 10  # answers in a row of the shuffle
_PACK = 1 << 18  # answers that a task packs together
_PLACED = 1 << 16  # keys that are put into a table at a time


def in_blocks(documents: DataFrame, text: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``documents`` in partitions of about a block, where there are more: the fewer blocks, the fewer keys are listed twice.

    Every core has work first.
    """
    nbytes = documents.agg(F.sum(F.octet_length(text))).first()[0] or 0
    return documents.coalesce(max(-(-nbytes // block_bytes), documents.sparkSession.sparkContext.defaultParallelism))


class Block:
    """The block that a task is at: its number, and what it has counted so far."""

    def __init__(self, block_bytes: int = BLOCK_BYTES):
        self.number = TaskContext.get().partitionId() << _BITS
        self.block_bytes, self.nbytes = block_bytes, 0
        self.counted: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}

    def count(self, kind: int, keys: np.ndarray, n: np.ndarray) -> None:
        """``keys``, 64 bits and of any order, were met ``n`` times each."""
        parts = self.counted.setdefault(kind, [])
        parts.append((keys.view(np.int64), n))
        if sum(len(k) for k, _ in parts[1:]) > _MERGE:
            self.merge(kind)

    def merge(self, kind: int) -> tuple[np.ndarray, np.ndarray]:
        """The distinct keys of a kind, sorted, and their counts; the first part from now on."""
        keys, n = (np.concatenate(part) for part in zip(*self.counted.pop(kind)))
        order = np.argsort(keys, kind="stable")
        keys, n = keys[order], n[order]
        if len(keys):
            first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
            keys, n = keys[first], np.add.reduceat(n, first)
        self.counted[kind] = [(keys, n)]
        return keys, n

    def is_full(self, nbytes: int) -> bool:
        """Whether the block ends with these further bytes of text."""
        self.nbytes += nbytes
        merged = sum(len(parts[0][0]) for parts in self.counted.values())
        return self.nbytes >= self.block_bytes or merged >= BLOCK_KEYS

    def lists(self) -> Iterator[dict]:
        """``block``, ``kind``, ``keys`` and ``counts``, a row each; then the next block begins."""
        for kind in list(self.counted):
            keys, n = self.merge(kind)
            for low in range(0, len(keys), LISTED):
                yield {
                    "block": pa.array([self.number], pa.int64()),
                    "kind": pa.array([kind], pa.int8()),
                    "keys": pa.array([keys[low : low + LISTED]], pa.list_(pa.int64())),
                    "counts": pa.array([n[low : low + LISTED]], pa.list_(pa.int64())),
                }
        self.number, self.nbytes, self.counted = self.number + 1, 0, {}


def entries(lists: DataFrame) -> DataFrame:
    """``(block, kind, key, n)`` from the rows of ``Block.lists``."""
    pairs = lists.select("block", "kind", F.explode(F.arrays_zip("keys", "counts")).alias("e"))
    return pairs.select("block", "kind", F.col("e.keys").alias("key"), F.col("e.counts").alias("n"))


def totals(entries: DataFrame) -> DataFrame:
    """``(kind, key, total)`` over the corpus."""
    return entries.groupBy("kind", "key").agg(F.sum("n").alias("total"))


def answered(entries: DataFrame, values: DataFrame, rows: DataFrame) -> DataFrame:
    """``rows`` (with ``block``) behind the ``values`` ``(kind, key, value)`` of their block's keys; see ``by_block``.

    ``values`` is a written table with one row per key, so the join may be split where many blocks have a key.
    """
    answers = entries.select("block", "kind", "key").join(values, ["kind", "key"]).select("block", "kind", "key", "value")
    both = answers.withColumn("is_row", F.lit(False)).unionByName(rows.withColumn("is_row", F.lit(True)), allowMissingColumns=True)
    return both.repartition("block").sortWithinPartitions("block", "is_row")


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Answers of one block and kind as lists of up to ``PACKED``, as far as a task has them together."""

    def rows(waiting: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(waiting)
        block, kind = table["block"].to_numpy(), table["kind"].to_numpy()
        order = np.lexsort((kind, block))
        block, kind = block[order], kind[order]
        begins = np.flatnonzero(np.concatenate([[True], (block[1:] != block[:-1]) | (kind[1:] != kind[:-1])]))
        sizes = np.diff(np.append(begins, len(block)))
        pieces = -(-sizes // PACKED)
        nth = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        first = np.repeat(begins, pieces) + nth * PACKED
        offsets = pa.array(np.append(first, len(block)), pa.int32())
        keys, values = (pa.ListArray.from_arrays(offsets, pa.array(table[name].to_numpy()[order])) for name in ("key", "value"))
        columns = {"block": pa.array(block[first]), "kind": pa.array(kind[first]), "keys": keys, "values": values}
        return pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    waiting, n = [], 0
    for batch in batches:
        if len(batch):
            waiting.append(batch)
            n += len(batch)
        if n >= _PACK:
            yield rows(waiting)
            waiting, n = [], 0
    if waiting:
        yield rows(waiting)


def answered_packed(entries: DataFrame, values: DataFrame, rows: DataFrame) -> DataFrame:
    """``answered``, with the answers shuffled and sorted as lists: 16 bytes each instead of a row as wide as ``rows``. They
    are rows of their own again before they leave Spark, so a batch stays as small as its number of rows says."""
    answers = entries.select("block", "kind", "key").join(values, ["kind", "key"]).select("block", "kind", "key", "value")
    kind_of = values.schema["value"].dataType.simpleString()
    lists = answers.mapInArrow(_packed, f"block long, kind byte, keys array<long>, values array<{kind_of}>")
    both = lists.withColumn("is_row", F.lit(False)).unionByName(rows.withColumn("is_row", F.lit(True)), allowMissingColumns=True)
    dealt = both.repartition("block").sortWithinPartitions("block", "is_row")
    single = dealt.select("block", "kind", "is_row", *[c for c in rows.columns if c != "block"], F.explode_outer(F.arrays_zip("keys", "values")).alias("e"))
    return single.select("block", "kind", F.col("e.keys").alias("key"), F.col("e.values").alias("value"), "is_row", *[c for c in rows.columns if c != "block"])


class Values:
    """The values of a block's keys of one kind, in a hash table with linear probing."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.keys, self.values = keys.view(np.uint64), values
        self.bits = max(4, (2 * len(keys)).bit_length())
        self.slots = np.full(1 << self.bits, -1, np.int32)
        for low in range(0, len(keys), _PLACED):  # piece by piece, as what is at work takes several times a key's bytes
            piece = self.keys[low : low + _PLACED]
            waiting, at = np.arange(low, low + len(piece), dtype=np.int32), self._start(piece)
            while len(waiting):
                free = self.slots[at] < 0
                self.slots[at[free]] = waiting[free]  # of several, one stays
                lost = self.slots[at] != waiting
                waiting, at = waiting[lost], (at[lost] + 1) & (len(self.slots) - 1)

    def _start(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def of(self, keys: np.ndarray) -> np.ndarray:
        """The value of each key, all of which the block has listed."""
        keys = keys.view(np.uint64)
        at = self._start(keys)
        found = self.slots[at]
        if len(found) and (not len(self.keys) or found.min() < 0):
            raise RuntimeError("rows differ from those that were listed")
        open_ = np.flatnonzero(self.keys[found] != keys) if len(found) else found
        at = at[open_]
        while len(open_):
            at = (at + 1) & (len(self.slots) - 1)
            place = self.slots[at]
            if place.min() < 0:
                raise RuntimeError("rows differ from those that were listed")
            found[open_] = place
            wrong = self.keys[place] != keys[open_]
            open_, at = open_[wrong], at[wrong]
        return self.values[found]


class Collected:
    """Keys and values that come in pieces, in arrays that grow by a fourth; kept pieces would be held twice when joined."""

    def __init__(self, value_type: np.dtype):
        self.keys, self.values, self.n = np.zeros(0, np.int64), np.zeros(0, value_type), 0

    def add(self, keys: np.ndarray, values: np.ndarray) -> None:
        end = self.n + len(keys)
        if end > len(self.keys):
            self._resize(max(end, len(self.keys) * 5 // 4))
        self.keys[self.n : end], self.values[self.n : end], self.n = keys, values, end

    def _resize(self, size: int) -> None:
        for column in (self.keys, self.values):
            column.resize(size, refcheck=False)

    def table(self) -> Values:
        self._resize(self.n)
        return Values(self.keys, self.values)


def by_block(batches: Iterator[pa.RecordBatch], kinds: int) -> Iterator[tuple[list[Values], pa.RecordBatch]]:
    """Batches of rows of one block, each with the values of that block, a ``Values`` per kind."""
    block, parts, known = None, [], None
    for batch in batches:
        value_type = batch.schema.field("value").type.to_pandas_dtype()
        blocks = batch.column("block").to_numpy()
        is_row = batch.column("is_row").to_numpy(zero_copy_only=False)
        edges = np.flatnonzero((blocks[1:] != blocks[:-1]) | (is_row[1:] != is_row[:-1])) + 1
        for low, high in zip([0, *edges.tolist()], [*edges.tolist(), len(blocks)]):
            if low == high:
                continue
            if blocks[low] != block:
                block, known = blocks[low], None  # what the last block had can go first
                parts = [Collected(value_type) for _ in range(kinds)]
            piece = batch.slice(low, high - low)
            if not is_row[low]:
                kind, key, value = (piece.column(name).to_numpy() for name in ("kind", "key", "value"))
                for k in range(kinds):
                    parts[k].add(key[kind == k], value[kind == k])
                continue
            if known is None:
                known = [part.table() for part in parts]
                parts = []
            yield known, piece
