"""Language-model scores by prediction by partial matching.

The model is a trie of byte contexts up to ``ORDER`` bytes, counted over all training texts. A symbol's probability comes
from the longest context that the training texts have; a context that has never been followed by the symbol passes on to the
next shorter one by an escape, which gets half a count of each different symbol seen there (method D), and the symbols
of the longer context are excluded from the shorter. Below all contexts every symbol left is equally likely. A text's code
length is the sum over its bytes and its end.

What a symbol costs after a context of ``ORDER`` bytes depends on these bytes alone, so it is worked out once per distinct
window of ``ORDER`` + 1 bytes of the corpus: windows are grouped by their last two bytes of context, which a group of the
trie's branches share, and the few counts of shorter contexts, at most 2^16, go to every task. Texts meet the costs of their
windows block by block (``blocks``), and the counts of their words as well. Both tables grow with the corpus.

Defined cases: null and empty texts consist of their end; rows without an id are held out as no id has a remainder of 2, so
they are training texts; repeated rows are each a text; further columns are ignored. Without training texts all
symbols are equally likely.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from quillrank.llm.blocks import Block, answered_packed, by_block, entries, in_blocks, totals
from quillrank.llm.ngram_join import batch_of
from quillrank.llm.words import Words, cut, slices
from quillrank.workspace import Workspace

ORDER = 5  # bytes of context, at most 7, so that a window fits into 64 bits
END = 0xFF  # a byte that UTF-8 does not use: the end of a text, and what stands before its start
SYMBOLS = 256
SMALL = 1  # orders whose counts go to every task: at most 2^16 of them
GROUP_ROWS = 1 << 19  # windows that are handled together, more for a larger group
SLICE_BYTES = 1 << 19
BLOCK_BYTES = 64 << 20  # of text whose distinct windows and words are listed once
_WINDOW, _WORD = 0, 1
_END_WORD = np.uint64(0x656E64)

_ROW = {
    "block": pa.int64(),
    "kind": pa.int8(),
    "keys": pa.list_(pa.int64()),
    "counts": pa.list_(pa.int64()),
    "texts": pa.binary(),
    "is_row": pa.bool_(),
}
_SCHEMA = "block long, kind byte, keys array<long>, counts array<long>, texts binary, is_row boolean"


def windows(words: Words, order: int) -> tuple[np.ndarray, np.ndarray]:
    """The windows of ``order`` bytes and the symbol after them, for every byte of every text and its end; and where each
    text's begin. Texts are lower-cased already."""
    sizes = np.diff(words.bounds)
    starts = words.bounds[:-1] + np.arange(len(sizes)) * (order + 1) + order  # in the padded texts
    padded = np.full(len(words.data) + len(sizes) * (order + 1), END, np.uint8)
    padded[np.arange(len(words.data)) + np.repeat(starts - words.bounds[:-1], sizes)] = words.data
    wide = padded.astype(np.uint64)
    out = np.zeros(len(wide), np.uint64)
    for back in range(order, -1, -1):
        out <<= np.uint64(8)
        out[back:] |= wide[: len(wide) - back]
    is_symbol = np.ones(len(wide), bool)
    is_symbol[(np.add.outer(starts - order, np.arange(order))).ravel()] = False
    return out[is_symbol], np.concatenate([[0], np.cumsum(sizes + 1)])


def word_keys(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints of the words of each text and of its end, and where each text's begin."""
    prints, first = words.fingerprints(), words.first
    out = np.full(len(prints) + len(first) - 1, _END_WORD, np.uint64)
    out[np.arange(len(prints)) + np.repeat(np.arange(len(first) - 1), np.diff(first))] = prints
    return out, first + np.arange(len(first))


def pack(batch: pa.RecordBatch) -> bytes:
    """Rows as a compressed value: texts are written, shuffled and sorted, and take a fraction of their bytes meanwhile."""
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
        writer.write_batch(batch)
    return sink.getvalue().to_pybytes()


def unpack(values: pa.Array) -> Iterator[pa.RecordBatch]:
    for value in values:
        with pa.ipc.open_stream(value.as_buffer()) as reader:
            yield from reader


def _listed(order: int):
    """The texts, packed, with their block, and per block its distinct windows and words with their counts in training texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = Block(BLOCK_BYTES)
        for batch in slices(batches, size=SLICE_BYTES):
            held_out = batch.column("held_out").to_numpy(zero_copy_only=False)
            words = cut(batch.column("text"), lower=True)
            for kind, (keys, first) in ((_WINDOW, windows(words, order)), (_WORD, word_keys(words))):
                trains = np.repeat(~held_out, np.diff(first))
                used, n = np.unique(keys[trains], return_counts=True)
                block.count(kind, used, n)
                unused = np.setdiff1d(keys[~trains], used)  # to be scored, but not counted
                block.count(kind, unused, np.zeros(len(unused), np.int64))
            yield _batch(1, block=[block.number], is_row=[True], texts=[pack(batch.select(["doc_id", "held_out", "text"]))])
            if block.is_full(len(words.data)):
                yield from (_batch(1, is_row=[False], **columns) for columns in block.lists())
        yield from (_batch(1, is_row=[False], **columns) for columns in block.lists())

    return run


def _batch(rows: int, **columns) -> pa.RecordBatch:
    given = {name: value if isinstance(value, pa.Array) else pa.array(value, _ROW[name]) for name, value in columns.items()}
    return batch_of(**{name: given.get(name, pa.nulls(rows, kind)) for name, kind in _ROW.items()})


class Level:
    """Counts of one order: ``keys`` are a context and a symbol, ``counts`` how often they were met."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray):
        met = counts > 0
        self.keys, of = np.unique(keys[met], return_inverse=True)
        self.counts = np.bincount(of, counts[met], len(self.keys)).astype(np.int64)
        contexts = self.keys >> np.uint64(8)
        self.contexts, first = np.unique(contexts, return_index=True)
        self.first = np.append(first, len(self.keys))
        self.total = self._sums(self.counts)
        self.distinct = np.diff(self.first)

    def _sums(self, values: np.ndarray) -> np.ndarray:
        below = np.concatenate([[0], np.cumsum(values)])
        return below[self.first[1:]] - below[self.first[:-1]]

    def excluded(self, lower: Level, size: int) -> np.ndarray:
        """For each context: what the symbols met there count in the shorter context of ``lower``."""
        return self._sums(lower.count(self.keys & mask(size)))

    def count(self, keys: np.ndarray) -> np.ndarray:
        at = find(self.keys, keys)
        return np.where(at >= 0, np.append(self.counts, 0)[at], 0)


def mask(size: int) -> np.uint64:
    return np.uint64((1 << (8 * size)) - 1)


def find(sorted_keys: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Where the keys are, or -1."""
    if not len(sorted_keys):
        return np.full(len(keys), -1)
    at = np.minimum(np.searchsorted(sorted_keys, keys), len(sorted_keys) - 1)
    return np.where(sorted_keys[at] == keys, at, -1)


def costs(keys: np.ndarray, counts: np.ndarray, order: int, small: list[Level]) -> np.ndarray:
    """Log10 probabilities of the symbols of ``keys``, windows of ``order`` bytes and a symbol that are all there are with
    their last bytes of context; ``small`` are the levels of the shortest contexts, of the whole corpus."""
    levels = [*small, *[Level(keys & mask(k + 1), counts) for k in range(len(small), order + 1)]]
    out, left = np.zeros(len(keys)), np.ones(len(keys), bool)
    out_total, out_distinct = (np.zeros(len(keys), np.int64) for _ in range(2))  # what is excluded in the next context
    for k in range(order, -1, -1):
        level, own = levels[k], keys & mask(k + 1)
        at = find(level.contexts, own >> np.uint64(8))
        total = np.where(at >= 0, np.append(level.total, 0)[at], 0) - out_total
        distinct = np.where(at >= 0, np.append(level.distinct, 0)[at], 0) - out_distinct
        asked = left & (at >= 0) & (distinct > 0)  # where all symbols are excluded the escape is certain
        n = level.count(own)
        hit = asked & (n > 0)
        halves = np.where(hit, 2 * n - 1, distinct)
        out[asked] += np.log10(halves[asked] / (2 * total[asked]))
        left &= ~hit
        if k:
            known = at >= 0
            gone = np.append(level.excluded(levels[k - 1], k), 0)[at]
            out_total, out_distinct = np.where(known, gone, 0), np.where(known, np.append(level.distinct, 0)[at], 0)
        else:
            out_distinct = np.where(at >= 0, np.append(level.distinct, 0)[at], 0)
    out[left] -= np.log10(np.maximum(SYMBOLS - out_distinct, 1)[left])
    return out


def _costs(order: int, small: list[tuple[np.ndarray, np.ndarray]]):
    """``(key, value)`` of windows that come in order of the last two bytes of their context."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        levels = [Level(*pair) for pair in small]
        keys, counts = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]

        def finished(keys, counts):
            return batch_of(key=pa.array(keys.view(np.int64)), value=pa.array(costs(keys, counts, order, levels)))

        for batch in batches:
            keys.append(batch.column("key").to_numpy().view(np.uint64))
            counts.append(batch.column("total").to_numpy())
            if sum(map(len, keys)) < GROUP_ROWS:
                continue
            all_keys, all_counts = np.concatenate(keys), np.concatenate(counts)
            groups = _branch(all_keys)
            whole = int(np.searchsorted(groups, groups[-1]))  # the last group may go on
            if whole:
                yield finished(all_keys[:whole], all_counts[:whole])
            keys, counts = [all_keys[whole:]], [all_counts[whole:]]
        all_keys = np.concatenate(keys)
        if len(all_keys):
            yield finished(all_keys, np.concatenate(counts))

    return run


def _branch(keys: np.ndarray) -> np.ndarray:
    return (keys >> np.uint64(8)) & mask(2)


def _scored(order: int, n_tokens: int, n_distinct: int):
    """The scores of texts that meet the values of their block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (window_costs, word_counts), rows in by_block(batches, 2):
            for batch in unpack(rows.column("texts")):
                words = cut(batch.column("text"), lower=True)
                keys, first = windows(words, order)
                below = np.concatenate([[0.0], np.cumsum(window_costs.of(keys))])
                prints, first_word = word_keys(words)
                n = word_counts.of(prints)
                parts = np.log10((n + 1) / (n_tokens + n_distinct + 1))
                sums = np.add.reduceat(parts, first_word[:-1]) if len(batch) else parts
                yield batch_of(
                    doc_id=batch.column("doc_id"),
                    held_out=batch.column("held_out"),
                    n_tokens=pa.array(np.diff(first_word), pa.int64()),
                    n_known=pa.array(np.add.reduceat((n > 0).astype(np.int64), first_word[:-1]) if len(batch) else n, pa.int64()),
                    base_score=pa.array(sums, pa.float64()),
                    score=pa.array(below[first[1:]] - below[first[:-1]], pa.float64()),
                )

    return run


def is_held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 7 == 2, F.lit(False))


def window_values(counted: DataFrame, order: int, workspace: Workspace) -> DataFrame:
    """``(key, value)``: the cost of every window in ``counted`` ``(key, total)``."""

    def small(size: int) -> tuple[np.ndarray, np.ndarray]:
        short = F.col("key").bitwiseAND(F.lit(int(mask(size + 1)))).alias("key")
        rows = counted.where(F.col("total") > 0).groupBy(short).agg(F.sum("total").alias("total")).toArrow()  # 256 to this power at most
        return rows["key"].to_numpy().view(np.uint64), rows["total"].to_numpy()

    levels = [small(size) for size in range(SMALL + 1)]
    branch = F.shiftrightunsigned("key", 8).bitwiseAND(F.lit(0xFFFF))
    ranged = counted.select("key", "total", branch.alias("branch")).repartition("branch").sortWithinPartitions("branch")
    return ranged.select("key", "total").mapInArrow(_costs(order, levels), "key long, value double")


def scored(documents: DataFrame, workspace: Workspace, order: int = ORDER) -> DataFrame:
    """``(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score)`` per row of ``documents`` (``doc_id``, ``text``).

    ``base_score`` adds up smoothed frequencies of words, ``score`` the costs of bytes and the end by the model, both log10.
    """
    if not 2 <= order <= 7:
        raise ValueError("order must be between 2 and 7")
    documents = documents.select(F.col("doc_id").cast("long").alias("doc_id"), is_held_out(F.col("doc_id")).alias("held_out"), "text")
    saved = workspace.save(in_blocks(documents, block_bytes=BLOCK_BYTES).mapInArrow(_listed(order), _SCHEMA), "listed", by="is_row")
    listed = entries(saved.where(~F.col("is_row")))
    counted = workspace.save(totals(listed), "counted")
    words = counted.where(F.col("kind") == _WORD)
    found = words.agg(F.sum("total").alias("n"), F.count_if(F.col("total") > 0).alias("distinct")).first()
    n_tokens, n_distinct = found["n"] or 0, found["distinct"]
    window_costs = window_values(counted.where(F.col("kind") == _WINDOW).select("key", "total"), order, workspace)
    values = window_costs.select(F.lit(_WINDOW).cast("byte").alias("kind"), "key", "value").union(
        words.select("kind", "key", F.col("total").cast("double").alias("value"))
    )
    values = workspace.save(values, "values")
    rows = saved.where("is_row").select("block", "texts")
    schema = "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"
    out = answered_packed(listed, values, rows).mapInArrow(_scored(order, n_tokens, n_distinct), schema)
    return out.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(n_tokens).cast("long").alias("train_tokens"), "base_score", "score")
