"""Alignment of two tokenizers over a corpus, in Arrow.

Each text, with a blank before it, is encoded by a byte-level tokenizer (A) and by a piece tokenizer (B). Token lists are
flattened, with the text of each token as parent index; segmented cumulative sums of byte lengths give where tokens
end, and a hash join on (text, end) finds the ends that both have. These cut the tokens into groups; a token of A and one of
B are linked when they are in the same group. How many texts link an id pair is counted per block of texts by
``Table.group_by`` and summed in Spark, and the sums come back to the blocks (``blocks``).

A group may be as long as a text where the tokenizers never agree. So ids are counted per group before they are paired, and
pairs are made ``PAIRS`` at a time, cut between ids of A; a text may have its pairs in several rows.

Defined cases: a text that is null or empty, or that one of the tokenizers does not give back byte for byte, has no tokens;
all its counts are 0 and its ``groups_sha256`` is empty. Repeated rows and rows without an id are each a text of their
own. Further columns are ignored. Strings of special tokens are plain text.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from quillrank.llm.blocks import Block, answered, by_block, entries, totals
from quillrank.llm.words import slices, spans
from quillrank.workspace import Workspace

TOKENIZERS = "/opt/tokenizers"  # a folder that every executor has
PAIRS = 1 << 21  # made at once
SLICE_BYTES = 1 << 18  # of text handled at once
_LOW = (1 << 32) - 1
_END_BITS = 40  # for a byte's place in a text

_ROW = {
    "block": pa.int64(),
    "kind": pa.int8(),
    "keys": pa.list_(pa.int64()),
    "counts": pa.list_(pa.int64()),
    "row": pa.int64(),
    "is_first": pa.bool_(),
    "doc_id": pa.int64(),
    "n_a": pa.int64(),
    "n_b": pa.int64(),
    "n_groups": pa.int64(),
    "n_links": pa.int64(),
    "groups_sha256": pa.string(),
    "is_row": pa.bool_(),
}
ROW_SCHEMA = (
    "block long, kind byte, keys array<long>, counts array<long>, row long, is_first boolean, doc_id long, n_a long, n_b long, "
    "n_groups long, n_links long, groups_sha256 string, is_row boolean"
)


class Tokens:
    """The bytes of every token of a vocabulary."""

    def __init__(self, entries: list[bytes]):
        self.sizes = np.array([len(e) for e in entries], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.data = np.frombuffer(b"".join(entries), np.uint8)
        digits = [str(i).encode() + b"," for i in range(len(entries))]  # a place for what follows the number
        self.digit_sizes = np.array([len(d) for d in digits], np.int64)
        self.digit_starts = np.cumsum(self.digit_sizes) - self.digit_sizes
        self.digits = np.frombuffer(b"".join(digits), np.uint8)

    def joined(self, ids: np.ndarray) -> np.ndarray:
        return self.data[spans(self.starts[ids], self.sizes[ids])]


def byte_symbols() -> dict[str, int]:
    """The byte that each symbol of a byte-level vocabulary stands for: printable Latin-1 for itself, others from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {**{chr(b): b for b in plain}, **{chr(0x100 + i): b for i, b in enumerate(others)}}


# Fixed value: how byte-level vocabularies cut texts before merging.
_PIECES = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_LONG_BLANK = re.compile(r"\s{1000}")


class ByteLevel:
    """A byte-level tokenizer file, run by the faster of two libraries that agree wherever that one can.

    It can where ids are in the order of merges, and on texts without very long runs of white space, on which its
    pattern overflows; the file's own library does the rest.
    """

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.whole.encode_special_tokens = True
        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        joined = ["".join(m) if isinstance(m, list) else m.replace(" ", "") for m in model["merges"]]
        symbol, vocabulary = byte_symbols(), model["vocab"]
        self.fast = None
        if all(vocabulary[name] == 256 + i for i, name in enumerate(joined)) and len(vocabulary) == 256 + len(joined):
            ranks = {bytes(symbol[c] for c in name): i for name, i in vocabulary.items()}
            self.fast = tiktoken.Encoding("byte-level", pat_str=_PIECES, mergeable_ranks=ranks, special_tokens={})
        names = {i: name for name, i in self.whole.get_vocab(with_added_tokens=True).items()}
        self.bytes = [bytes(symbol.get(c, 0x20) for c in names.get(i, "")) for i in range(max(names) + 1)]

    def encode(self, text: str) -> list[int]:
        if self.fast and not _LONG_BLANK.search(text):
            return self.fast.encode_ordinary(text)
        return self.whole.encode(text, add_special_tokens=False).ids


@lru_cache(maxsize=2)
def load(folder: str):
    """Both tokenizers and their tokens, once per process."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    import sentencepiece

    a = ByteLevel(os.path.join(folder, "byte_bpe_50k.json"))
    b = sentencepiece.SentencePieceProcessor(model_file=os.path.join(folder, "piece_bpe_32k.model"))
    b_bytes = []
    for i in range(b.get_piece_size()):
        piece = b.id_to_piece(i)
        b_bytes.append(bytes([int(piece[3:5], 16)]) if b.is_byte(i) else piece.replace("▁", " ").encode())
    return a, b, Tokens(a.bytes), Tokens(b_bytes)


class Encoded:
    """The tokens of some texts by one tokenizer: ids, parent indices and ends, flat."""

    def __init__(self, lists: list[list[int]], tokens: Tokens):
        column = pa.array(lists, pa.list_(pa.int32()))
        self.tokens = tokens
        self.ids = pc.list_flatten(column).to_numpy(zero_copy_only=False)
        self.text = pc.list_parent_indices(column).to_numpy(zero_copy_only=False)
        self.n_texts = len(column)
        self.counts = np.bincount(self.text, minlength=self.n_texts)

    def sizes(self) -> np.ndarray:
        """Bytes of each text, as the tokens give it."""
        return np.bincount(self.text, self.tokens.sizes[self.ids], self.n_texts).astype(np.int64)

    def of(self, texts: np.ndarray) -> Encoded:
        """The tokens of the texts marked."""
        out = object.__new__(Encoded)
        keep = texts[self.text]
        out.tokens, out.n_texts = self.tokens, self.n_texts
        out.ids, out.text = self.ids[keep], self.text[keep]
        out.counts = np.bincount(out.text, minlength=self.n_texts)
        return out

    def ends(self) -> pa.Table:
        """``(at, token)``: where each token ends, the text and the end within it as one number."""
        sizes = pa.array(self.tokens.sizes[self.ids])
        sums = pc.cumulative_sum(sizes).to_numpy(zero_copy_only=False) if len(sizes) else np.zeros(0, np.int64)
        first = np.cumsum(self.counts) - self.counts
        before = np.concatenate([[0], sums])[first]
        at = (self.text.astype(np.int64) << _END_BITS) | (sums - before[self.text])
        return pa.table({"at": at, "token": np.arange(len(self.ids), dtype=np.int32)})


def same_bytes(encoded: Encoded, raw: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Which texts the tokens give back byte for byte."""
    fits = encoded.sizes() == np.diff(bounds)
    part = encoded.of(fits)
    wanted = raw[spans(bounds[:-1][fits], np.diff(bounds)[fits])]
    wrong = np.repeat(np.flatnonzero(fits), np.diff(bounds)[fits])[part.tokens.joined(part.ids) != wanted]
    fits[wrong] = False
    return fits


def groups_of(a: Encoded, b: Encoded) -> tuple[np.ndarray, np.ndarray]:
    """The number of the group of each token of A and of B. Every text's last ends agree, so no group spans two texts."""
    common = a.ends().join(b.ends(), keys="at", join_type="inner", right_suffix="_b", use_threads=False)
    out = []
    for side, name in ((a, "token"), (b, "token_b")):
        is_end = np.zeros(len(side.ids), np.int64)
        is_end[common[name].to_numpy()] = 1
        out.append(np.cumsum(is_end) - is_end)
    return out[0], out[1]


def listed(a: Encoded, b: Encoded, group_a: np.ndarray, group_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``a1,a2|b1;a3|b2,b3`` of all texts in a row, as bytes, and where each text ends; its last character is a ``;``."""
    n_groups = int(group_b[-1]) + 1 if len(group_b) else 0
    in_a, in_b = np.bincount(group_a, minlength=n_groups), np.bincount(group_b, minlength=n_groups)
    place_a = np.arange(len(group_a)) + (np.cumsum(in_b) - in_b)[group_a]
    place_b = np.arange(len(group_b)) + np.cumsum(in_a)[group_b]
    starts, sizes = (np.empty(len(group_a) + len(group_b), np.int64) for _ in range(2))
    for side, place, shift in ((a, place_a, 0), (b, place_b, len(a.tokens.digits))):
        starts[place] = side.tokens.digit_starts[side.ids] + shift
        sizes[place] = side.tokens.digit_sizes[side.ids]
    out = np.concatenate([a.tokens.digits, b.tokens.digits])[spans(starts, sizes)]
    ends = np.cumsum(sizes)
    if n_groups:
        out[ends[np.cumsum(in_a + in_b) - in_b - 1] - 1] = ord("|")
        out[ends[np.cumsum(in_a + in_b) - 1] - 1] = ord(";")
    return out, np.concatenate([[0], ends])[np.cumsum(a.counts + b.counts)]


def links(a: Encoded, b: Encoded, group_a: np.ndarray, group_b: np.ndarray) -> Iterator[pa.Table]:
    """``(text, key, n)``: the distinct id pairs of each text and how often they are linked, ``PAIRS`` or so at a time."""
    sides = []
    for side, group in ((a, group_a), (b, group_b)):
        key = (group << 32) | side.ids
        if len(key) and (np.bincount(group).max() > 1):
            counted = pa.table({"key": key}).group_by("key", use_threads=False).aggregate([([], "count_all")])
            key, n = counted["key"].to_numpy(), counted["count_all"]
        else:
            n = pa.array(np.ones(len(key), np.int64))
        sides.append(pa.table({"group": (key >> 32).astype(np.int32), "id": key & _LOW, "count_all": n}))
    left, right = sides
    if not len(left):
        return
    text_of = np.zeros(int(group_a[-1]) + 1, np.int32)
    text_of[group_a] = a.text
    left = left.append_column("text", pa.array(text_of[left["group"].to_numpy()]))
    partners = np.bincount(right["group"].to_numpy())[left["group"].to_numpy()]
    cuts = [0, len(left)]
    if partners.sum() > PAIRS:  # in order of text and id, cut between ids
        order = np.lexsort((left["id"].to_numpy(), left["text"].to_numpy()))
        left, partners = left.take(pa.array(order)), partners[order]
        of = (left["text"].to_numpy().astype(np.int64) << 32) | left["id"].to_numpy()
        begins = np.concatenate([[0], np.flatnonzero(of[1:] != of[:-1]) + 1])
        before = (np.cumsum(partners) - partners)[begins]
        cuts = [*begins[np.unique(before // PAIRS, return_index=True)[1]].tolist(), len(left)]
    for low, high in zip(cuts[:-1], cuts[1:]):
        met = left.slice(low, high - low).join(right, keys="group", join_type="inner", right_suffix="_b", use_threads=False)
        key = pc.bit_wise_or(pc.shift_left(met["id"], 32), met["id_b"])
        pairs = pa.table({"text": met["text"], "key": key, "n": pc.multiply(met["count_all"], met["count_all_b"])})
        summed = pairs.group_by(["text", "key"], use_threads=False).aggregate([("n", "sum")])
        yield summed.rename_columns({"n_sum": "n"}).sort_by([("text", "ascending"), ("key", "ascending")])


def _batch(rows: int, **columns) -> pa.RecordBatch:
    given = {name: value if isinstance(value, pa.Array) else pa.array(value, _ROW[name]) for name, value in columns.items()}
    return pa.RecordBatch.from_arrays([given.get(name, pa.nulls(rows, kind)) for name, kind in _ROW.items()], names=list(_ROW))


def _align(folder: str):
    """A row per text, more for one with very many pairs, and per block rows that list its id pairs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, row = Block(), 0
        for batch in slices(batches, size=SLICE_BYTES):
            yield from _aligned(batch, folder, block, row)
            row += len(batch)
            if block.is_full(pc.sum(pc.binary_length(batch.column("text").fill_null(""))).as_py() or 0):
                yield from (_batch(1, is_row=[False], **columns) for columns in block.lists())
        yield from (_batch(1, is_row=[False], **columns) for columns in block.lists())

    return run


def _aligned(batch: pa.RecordBatch, folder: str, block: Block, row: int) -> Iterator[pa.RecordBatch]:
    tokenizer_a, tokenizer_b, tokens_a, tokens_b = load(folder)
    texts = [text or "" for text in batch.column("text").to_pylist()]
    raw = [f" {text}".encode() if text else b"" for text in texts]
    bounds = np.concatenate([[0], np.cumsum([len(r) for r in raw])])
    a = Encoded([tokenizer_a.encode(f" {t}") if t else [] for t in texts], tokens_a)
    b = Encoded([ids if t else [] for t, ids in zip(texts, tokenizer_b.encode(texts, num_threads=1))], tokens_b)
    flat = np.frombuffer(b"".join(raw), np.uint8)
    valid = same_bytes(a, flat, bounds) & same_bytes(b, flat, bounds)
    a, b = a.of(valid), b.of(valid)
    group_a, group_b = groups_of(a, b)

    n_groups = int(group_a[-1]) + 1 if len(group_a) else 0
    in_a, in_b = np.bincount(group_a, minlength=n_groups), np.bincount(group_b, minlength=n_groups)
    text_of = np.zeros(n_groups, np.int64)
    text_of[group_a] = a.text
    n_links = np.zeros(len(texts), np.int64)
    np.add.at(n_links, text_of, in_a * in_b)
    out, ends = listed(a, b, group_a, group_b)
    out, ends = out.tobytes(), np.concatenate([[0], ends]).tolist()
    digest = [hashlib.sha256(out[x : y - 1]).hexdigest() if y > x else "" for x, y in zip(ends[:-1], ends[1:])]

    seen = np.zeros(len(texts), bool)
    about = {
        "doc_id": batch.column("doc_id"),
        "n_a": pa.array(a.counts, pa.int64()),
        "n_b": pa.array(b.counts, pa.int64()),
        "n_groups": pa.array(np.bincount(text_of, minlength=len(texts)), pa.int64()),
        "n_links": pa.array(n_links),
        "groups_sha256": pa.array(digest, pa.string()),
    }

    def rows(which: np.ndarray, keys: pa.Array, counts: pa.Array) -> pa.RecordBatch:
        first = ~seen[which]
        seen[which] = True
        own = {name: column.take(pa.array(which)) for name, column in about.items()}
        fixed = {"block": np.full(len(which), block.number), "row": which + row, "is_first": first, "is_row": np.ones(len(which), bool)}
        return _batch(len(which), **fixed, **own, keys=keys, counts=counts)

    for pairs in links(a, b, group_a, group_b):
        text, key, n = (pairs[name].to_numpy() for name in ("text", "key", "n"))
        block.count(0, *np.unique(key, return_counts=True))
        which, start = np.unique(text, return_index=True)
        offsets = pa.array(np.append(start, len(text)), pa.int32())
        yield rows(which, *(pa.ListArray.from_arrays(offsets, pa.array(x, pa.int64())) for x in (key, n)))
    rest = np.flatnonzero(~seen)
    none = pa.array([[]] * len(rest), pa.list_(pa.int64()))
    yield rows(rest, none, none)


_SUMMED = "block long, row long, is_first boolean, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, n_best long, count_sum long"


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows with what their pairs add up to. A value is twice a count, and one more if it is the highest of its id of A."""
    for (values,), batch in by_block(batches, 1):
        keys, times = batch.column("keys"), pc.list_flatten(batch.column("counts")).to_numpy()
        parent = pc.list_parent_indices(keys).to_numpy()
        value = values.of(pc.list_flatten(keys).to_numpy())
        n_best, count_sum = np.zeros(len(batch), np.int64), np.zeros(len(batch), np.int64)
        np.add.at(n_best, parent, times * (value & 1))
        np.add.at(count_sum, parent, times * (value >> 1))
        names = ["block", "row", "is_first", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
        columns = [batch.column(name) for name in names]
        yield pa.RecordBatch.from_arrays([*columns, pa.array(n_best), pa.array(count_sum)], names=[*names, "n_best", "count_sum"])


def aligned(documents: DataFrame, workspace: Workspace, folder: str = TOKENIZERS) -> DataFrame:
    """``(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256)`` per row of ``documents`` (``doc_id``, ``text``).

    ``n_best`` are links whose pair no other of the same id of A exceeds in documents that have it linked; ``count_sum`` adds
    these document counts up over all links.
    """
    documents = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    saved = workspace.save(documents.mapInArrow(_align(folder), ROW_SCHEMA), "aligned", by="is_row")
    listed_pairs = entries(saved.where(~F.col("is_row")))
    rows = saved.where("is_row").drop("is_row", "kind")
    values = workspace.save(pair_counts(listed_pairs, workspace).select("kind", "key", _value().alias("value")), "values")
    summed = answered(listed_pairs, values, rows).mapInArrow(_summed, _SUMMED)
    first = [F.max(F.when(F.col("is_first"), F.col(c))).alias(c) for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")]
    found = summed.groupBy("block", "row").agg(*first, F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    return found.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def _value():
    return F.col("total") * 2 + (F.col("total") == F.col("highest")).cast("long")


def pair_counts(listed_pairs: DataFrame, workspace: Workspace) -> DataFrame:
    """``(kind, key, total, highest)``: the documents that have each id pair linked, and the most of any pair with its id of A.

    There are no more ids of A than its vocabulary has, so their highest counts may be broadcast.
    """
    counted = workspace.save(totals(listed_pairs), "pairs")
    highest = counted.groupBy(F.shiftright("key", 32).alias("id_a")).agg(F.max("total").alias("highest"))
    return counted.withColumn("id_a", F.shiftright("key", 32)).join(F.broadcast(highest), "id_a").drop("id_a")


def id_pairs(documents: DataFrame, workspace: Workspace, folder: str = TOKENIZERS) -> DataFrame:
    """``(id_a, id_b, documents, is_best)``: how many documents have an id of A linked with one of B, and whether that is the
    most for the id of A."""
    saved = workspace.save(documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_align(folder), ROW_SCHEMA), "aligned", by="is_row")
    counted = pair_counts(entries(saved.where(~F.col("is_row"))), workspace)
    return counted.select(
        F.shiftright("key", 32).cast("int").alias("id_a"),
        F.col("key").bitwiseAND(F.lit(_LOW)).cast("int").alias("id_b"),
        F.col("total").alias("documents"),
        (F.col("total") == F.col("highest")).alias("is_best"),
    )
