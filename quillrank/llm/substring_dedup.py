"""Substring dedup with fixed-block anchors.

Every text is cut into blocks of 25 words, and the blocks are an index; every run of 25 words of every text probes it. A
window of 50 words holds a whole block, so whatever window two texts share, one's block is hit by the other's probe. Around
the hits, and only there, windows are compared: the first document of a window keeps it. So hits grow to the maximal
repeats, in steps of one word, however many documents share them.

A probe is shuffled only if a bitmap of the blocks says that it may hit. Blocks that are frequent are known after
the first pass; their rows need no lookup and are dealt out evenly, and so are the windows around them.

Words, blocks and windows are compared by fingerprints of 64 bits. Defined cases: null and empty texts have no words; rows
without an id remove nothing and lose nothing; rows of one id are not before each other, so repeated rows keep their words;
further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from quillrank.llm.bitmap import bitmap, maybe, size_for
from quillrank.llm.ngram_join import Counter, Order, Unseen, batch_of, frequent_rows
from quillrank.llm.words import Words, cut, mix, run_fingerprints, slices
from quillrank.workspace import Workspace

WINDOW = 50
BLOCK = WINDOW // 2  # any WINDOW words hold a whole block of that size
FREQUENT = 1e-5  # share of all blocks from which one counts as frequent


def text_names(words: Words, prints: np.ndarray) -> np.ndarray:
    """A name for each text, the same for the same words in the same order."""
    place = np.arange(len(prints), dtype=np.uint64) - np.repeat(words.first[:-1], words.counts).astype(np.uint64)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(prints ^ mix(place, 21), 22))])
    return mix(sums[words.first[1:]] - sums[words.first[:-1]], 23) ^ words.counts.astype(np.uint64)


def block_starts(words: Words) -> np.ndarray:
    """First words of the blocks of texts that have a window."""
    blocks = np.where(words.counts >= WINDOW, words.counts // BLOCK, 0)
    place = np.arange(blocks.sum()) - np.repeat(np.cumsum(blocks) - blocks, blocks)
    return np.repeat(words.first[:-1], blocks) + place * BLOCK


def kept_bytes(words: Words, keep: np.ndarray) -> list[bytes]:
    """The kept words of each text, joined by one blank."""
    owner = np.repeat(np.arange(len(words.counts)), words.counts)
    chosen = np.flatnonzero(keep)
    edge = np.zeros(len(words.data) + 1, dtype=np.int8)
    edge[words.start[chosen]] += 1
    np.subtract.at(edge, words.end[chosen], 1)
    take = np.cumsum(edge[:-1]) > 0
    data = words.data.copy()
    if len(chosen):
        more = owner[chosen[:-1]] == owner[chosen[1:]]  # a kept word of the same text follows, so a blank does
        blanks = words.end[chosen[:-1][more]]
        data[blanks] = 0x20
        take[blanks] = True
    below = np.concatenate([[0], np.cumsum(take)])
    out, bounds = data[take].tobytes(), below[words.bounds].tolist()
    return [out[a:b] for a, b in zip(bounds[:-1], bounds[1:])]


def digests(texts: list[bytes]) -> pa.Array:
    return pa.array([hashlib.sha256(text).hexdigest() for text in texts], pa.string())


def _describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per document with its blocks, and at a task's end one that lists the blocks that are frequent in it."""
    counter = Counter(int(2 / FREQUENT))
    for batch in slices(batches):
        words = cut(batch.column("text"), lower=False)
        prints = words.fingerprints()
        starts = block_starts(words)
        blocks = run_fingerprints(prints, starts, BLOCK)
        counter.add(blocks)
        ends = np.searchsorted(starts, words.first).astype(np.int32)
        rows = len(words.counts)
        yield batch_of(
            doc_id=batch.column("doc_id"),
            n=pa.array(words.counts, pa.int64()),
            name=pa.array(text_names(words, prints).view(np.int64)),
            whole=digests(kept_bytes(words, np.ones(len(prints), dtype=bool))),
            grams=pa.ListArray.from_arrays(pa.array(ends), pa.array(blocks.view(np.int64))),
            counts=pa.nulls(rows, pa.list_(pa.int64())),
        )
    counter.settle()
    often = counter.counts >= max(2, FREQUENT * counter.total)
    yield batch_of(
        doc_id=pa.nulls(1, pa.int64()),
        n=pa.nulls(1, pa.int64()),
        name=pa.nulls(1, pa.int64()),
        whole=pa.nulls(1, pa.string()),
        grams=pa.array([counter.keys[often].view(np.int64)], pa.list_(pa.int64())),
        counts=pa.array([counter.counts[often]], pa.list_(pa.int64())),
    )


def _turned(grams: np.ndarray) -> np.ndarray:
    return (grams >> np.uint64(32)) | (grams << np.uint64(32))


def _probes(bits: np.ndarray, order: Order):
    """``(gram, name, place, is_block, is_frequent)``: the blocks of each text, and what may hit a block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unseen = Unseen()
        for batch in slices(batches):
            words = cut(batch.column("text"), lower=False)
            prints = words.fingerprints()
            names = text_names(words, prints)
            starts, owners = words.run_starts(BLOCK)
            grams = run_fingerprints(prints, starts, BLOCK)
            use = (words.counts >= WINDOW) & unseen(names)
            place = starts - words.first[owners]
            is_block = place % BLOCK == 0
            keep = use[owners] & (is_block | (maybe(bits, grams) & maybe(bits, _turned(grams))))
            grams, owners = grams[keep], owners[keep]
            yield batch_of(
                gram=pa.array(grams.view(np.int64)),
                name=pa.array(names[owners].view(np.int64)),
                place=pa.array(place[keep], pa.int32()),
                is_block=pa.array(is_block[keep]),
                is_frequent=pa.array(order.ranks(grams) > 0),
            )

    return run


def _named(wanted: np.ndarray):
    """``(name, text)`` of the texts that may be ``wanted``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unseen = Unseen()
        for batch in slices(batches):
            words = cut(batch.column("text"), lower=False)
            names = text_names(words, words.fingerprints())
            take = maybe(wanted, names)
            take &= unseen(names)
            chosen = pa.array(take)
            yield batch_of(name=pa.array(names.view(np.int64)).filter(chosen), text=batch.column("text").filter(chosen))

    return run


def _covering(words: Words, text: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Which words start a window that holds the block at one of the places."""
    base, count = words.first[text], words.counts[text]
    low, high = np.maximum(place - BLOCK, 0), np.minimum(place, count - WINDOW)
    edge = np.zeros(len(words.start) + 1, dtype=np.int64)
    fits = low <= high
    np.add.at(edge, (base + low)[fits], 1)
    np.add.at(edge, (base + high + 1)[fits], -1)
    return np.cumsum(edge[:-1]) > 0


def _flat(lists: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The elements of all lists, and which list each is from."""
    sizes = pc.list_value_length(lists).fill_null(0).to_numpy(zero_copy_only=False)
    return np.repeat(np.arange(len(lists)), sizes), lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)


def _windows(order: Order):
    """``(gram, name, first, place, is_frequent)`` of the windows around hits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            words = cut(batch.column("text"), lower=False)
            prints = words.fingerprints()
            text, place = _flat(batch.column("places"))
            starts = np.flatnonzero(_covering(words, text, place))
            often = order.ranks(run_fingerprints(prints, words.first[text] + place, BLOCK)) > 0
            is_frequent = _covering(words, text[often], place[often])[starts]
            owners = np.searchsorted(words.first, starts, "right") - 1
            whose = pa.array(owners)
            yield batch_of(
                gram=pa.array(run_fingerprints(prints, starts, WINDOW).view(np.int64)),
                name=batch.column("name").take(whose),
                first=batch.column("first").take(whose),
                place=pa.array(starts - words.first[owners], pa.int32()),
                is_frequent=pa.array(is_frequent),
            )

    return run


def _cut_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(name, n_removed, kept, spans)`` from texts and the windows that are repeats."""
    for batch in slices(batches):
        words = cut(batch.column("text"), lower=False)
        text, place = _flat(batch.column("repeats"))
        edge = np.zeros(len(words.start) + 1, dtype=np.int64)
        np.add.at(edge, words.first[text] + place, 1)
        np.add.at(edge, words.first[text] + place + WINDOW, -1)
        gone = np.cumsum(edge[:-1]) > 0
        owner = np.repeat(np.arange(len(words.counts)), words.counts)
        border = np.ones(len(gone) + 1, dtype=bool)
        border[1:-1] = owner[1:] != owner[:-1]
        begins = np.flatnonzero(gone & (border[:-1] | ~np.concatenate([[False], gone[:-1]])))
        ends = np.flatnonzero(gone & (border[1:] | ~np.concatenate([gone[1:], [False]]))) + 1
        of = owner[begins]
        spans = pa.StructArray.from_arrays(
            [pa.array(begins - words.first[of], pa.int64()), pa.array(ends - words.first[of], pa.int64())], names=["start", "end"]
        )
        bounds = np.searchsorted(begins, words.first).astype(np.int32)
        below = np.concatenate([[0], np.cumsum(gone)])
        yield batch_of(
            name=batch.column("name"),
            n_removed=pa.array(below[words.first[1:]] - below[words.first[:-1]], pa.int64()),
            kept=digests(kept_bytes(words, ~gone)),
            spans=pa.ListArray.from_arrays(pa.array(bounds), spans),
        )


SPANS = "array<struct<start:long,end:long>>"


def repeats(documents: DataFrame, workspace: Workspace) -> DataFrame:
    """``(doc_id, n_words, n_removed, kept_sha256, removed)`` per row of ``documents`` (``doc_id``, a whole number, ``text``).

    A word is removed if a window of ``WINDOW`` words that covers it also starts in a document with a smaller id.
    ``removed`` are the runs of such words, ``[start, end)``; ``kept_sha256`` is of the others, joined by one blank.
    """
    documents = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    schema = "doc_id long, n long, name long, whole string, grams array<long>, counts array<long>"
    described = workspace.save(documents.mapInArrow(_describe, schema), "described")
    texts = described.where(F.col("n").isNotNull()).select("doc_id", "n", "name", "whole")
    # Written, as joins may split a name that many rows have only where no aggregate lies below them.
    classes = workspace.save(texts.groupBy("name").agg(F.min("doc_id").alias("first")), "classes")

    blocks = described.where(F.col("n") > 0).select(F.explode("grams").alias("gram"))
    n_blocks = described.agg(F.sum(F.when(F.col("n") > 0, F.size("grams")))).first()[0] or 0
    order = frequent_rows(described, FREQUENT * n_blocks)
    turned = F.shiftrightunsigned("gram", 32).bitwiseOR(F.shiftleft("gram", 32))
    keys = blocks.select(F.explode(F.array("gram", turned)).alias("gram"))
    bits = bitmap(keys, F.col("gram"), size_for(n_blocks))

    anchors = _anchors(documents, bits, order, classes, workspace)
    count = anchors.count()
    wanted = bitmap(anchors, F.col("name"), size_for(count))
    named = documents.select("text").mapInArrow(_named(wanted), "name long, text string")
    suspects = anchors.join(named, "name").groupBy("name", "first", "places").agg(F.first("text").alias("text"))
    suspects = workspace.save(suspects, "suspects")

    by_text = _repeated(suspects, order).groupBy("name").agg(F.collect_list("place").alias("repeats"))
    joined = suspects.select("name", "text").join(by_text, "name").select("name", "text", "repeats")
    cut_out = joined.mapInArrow(_cut_out, f"name long, n_removed long, kept string, spans {SPANS}")
    return _result(texts, classes, workspace.save(cut_out, "cut"))


def _anchors(documents: DataFrame, bits: np.ndarray, order: Order, classes: DataFrame, workspace: Workspace) -> DataFrame:
    """``(name, first, places)``: where texts have runs of ``BLOCK`` words that a block and another text have."""
    schema = "gram long, name long, place int, is_block boolean, is_frequent boolean"
    rows = documents.select("text").mapInArrow(_probes(bits, order), schema)
    key = F.when(F.col("is_frequent"), F.xxhash64("gram", "name", "place")).otherwise(F.col("gram"))
    by_key = "over (partition by key)"
    hit = F.expr(f"min(name) {by_key} <> max(name) {by_key} and bool_or(is_block) {by_key}")
    marked = rows.withColumn("key", key).withColumn("hit", hit).where(F.col("is_frequent") | F.col("hit"))
    places = marked.groupBy("name").agg(F.collect_set("place").alias("places"))
    return workspace.save(places.join(classes.where(F.col("first").isNotNull()), "name"), "anchors")


def _repeated(suspects: DataFrame, order: Order) -> DataFrame:
    """``(name, place)`` of the windows that a document with a smaller id has.

    Windows around frequent blocks are dealt to many tasks. There all rows but the first are repeats already; the firsts
    of all tasks are compared once more.
    """
    rows = suspects.mapInArrow(_windows(order), "gram long, name long, first long, place int, is_frequent boolean")
    salts = int(suspects.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    salt = F.when(F.col("is_frequent"), F.pmod(F.xxhash64("name"), F.lit(salts))).otherwise(F.lit(0))
    keyed = rows.withColumn("salt", salt).withColumn("least", F.expr("min(first) over (partition by gram, salt)"))
    # A text's row in a task holds for the task: which rows are undecided depends on whole groups only.
    marked = keyed.withColumn("is_repeat", F.col("least") < F.col("first"))
    again = marked.where(F.col("is_repeat") | F.col("is_frequent")).withColumn(
        "key", F.when(F.col("is_repeat"), F.xxhash64("gram", "name", "place")).otherwise(F.col("gram"))
    )
    last = again.withColumn("least", F.expr("min(first) over (partition by key, is_repeat)"))
    return last.where(F.col("is_repeat") | (F.col("least") < F.col("first"))).select("name", "place")


def _result(texts: DataFrame, classes: DataFrame, cut_out: DataFrame) -> DataFrame:
    known = texts.join(classes, "name").join(cut_out, "name", "left")
    is_copy = F.coalesce((F.col("doc_id") > F.col("first")) & (F.col("n") >= WINDOW), F.lit(False))
    is_first = F.col("doc_id").isNotNull()
    none = F.array().cast(SPANS)
    whole = F.array(F.struct(F.lit(0).cast("long").alias("start"), F.col("n").alias("end")))
    empty = F.sha2(F.lit("").cast("binary"), 256)
    pick = lambda copy, first, other: F.when(is_copy, copy).when(is_first, F.coalesce(first, other)).otherwise(other)
    return known.select(
        "doc_id",
        F.col("n").alias("n_words"),
        pick(F.col("n"), F.col("n_removed"), F.lit(0)).alias("n_removed"),
        pick(empty, F.col("kept"), F.col("whole")).alias("kept_sha256"),
        pick(whole, F.col("spans"), none).alias("removed"),
    )
