"""Mixing sources to target weights, in fixed-length blocks of words.

The words of a source lie on a line, document after document, cut into blocks. A source's share of the mix is a number
of slots; slot i holds block ``p(i mod blocks)`` for a pseudorandom permutation p of the source's blocks, so every block
is taken once before any is taken twice. All slots of all sources are numbered in a row and laid out by one more
permutation; ``shard_slots`` consecutive places make an output shard. So what a shard holds of each source is a
multinomial draw, given that the totals are met exactly. Only built-in expressions are used.

Defined cases: null and empty texts have no words and are never taken; rows of a null source are a source, the last one;
repeated rows each have a place of their own; columns that are not asked for are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from quillrank.workspace import Workspace

# Weights of the sources in order, repeated; size of the mix against all words; most repeats.
WEIGHTS = (3, 1, 2)
TOTAL = 1.5
REPEATS = 2

BLOCK_WORDS = 128
SHARD_SLOTS = 4096
BUCKET_ROWS = 8192  # documents in one running sum
CHUNK = 1 << 14  # numbers that one row is expanded to
ROUNDS = 24
WORD = r"[^\x20\x09-\x0D]+"


def count_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def shuffled(number: Column, size: Column, seed: Column, invert: bool = False) -> Column:
    """A pseudorandom permutation of 0 to ``size - 1``, other ones for other seeds.

    Swap-or-not: in every round a number and its mirror image at a random point change places, or stay. A round undoes
    itself, so the rounds backwards are the inverse.
    """
    rounds = range(ROUNDS - 1, -1, -1) if invert else range(ROUNDS)

    def swap(x: Column, r: Column) -> Column:
        other = F.pmod(F.pmod(F.xxhash64(seed, r), size) - x, size)
        return F.when(F.pmod(F.xxhash64(seed, r, F.greatest(x, other)), F.lit(2)) == 1, other).otherwise(x)

    return F.aggregate(F.array(*[F.lit(r) for r in rounds]), number.cast("long"), swap)


@dataclass(frozen=True)
class Placed:
    """``sources``: one row per source. ``documents``: the input with ``source_no``, ``size`` and ``start``."""

    sources: DataFrame
    documents: DataFrame


def source_targets(sizes: DataFrame) -> DataFrame:
    """``(source, rows, source_size, source_no, target)`` from ``(source, size)``; one row per source.

    Targets are ``least(REPEATS * source_size, level * weight)`` with the level at which they add up to ``TOTAL`` of all
    words. Sources in order of the level at which they are full: as long as a source is full, its limit is set apart, and
    the others share what is left. The two windows have one row per source.
    """
    by_source = sizes.groupBy("source").agg(F.count(F.lit(1)).alias("rows"), F.sum("size").alias("source_size"))
    numbered = by_source.withColumn(
        "source_no", F.row_number().over(Window.partitionBy().orderBy(F.col("source").asc_nulls_last())) - 1
    )
    weight = F.element_at(F.array(*[F.lit(w) for w in WEIGHTS]), (F.col("source_no") % len(WEIGHTS) + 1).cast("int"))
    limits = numbered.withColumn("weight", weight).withColumn("limit", F.col("source_size") * F.lit(REPEATS))
    ordered = Window.partitionBy().orderBy(F.col("limit") / F.col("weight"), "source_no")
    below, above = ordered.rowsBetween(Window.unboundedPreceding, -1), ordered.rowsBetween(0, Window.unboundedFollowing)
    levels = limits.withColumn(
        "level",
        (F.sum("source_size").over(Window.partitionBy()) * F.lit(TOTAL) - F.coalesce(F.sum("limit").over(below), F.lit(0)))
        / F.sum("weight").over(above),
    ).withColumn("open", F.col("level") * F.col("weight") < F.col("limit"))
    level = F.min(F.when(F.col("open"), F.struct(F.col("limit") / F.col("weight"), "source_no", "level"))).over(Window.partitionBy())
    target = F.least(F.col("limit").cast("double"), F.coalesce(level["level"] * F.col("weight"), F.col("limit").cast("double")))
    return levels.select("source", "rows", "source_size", "source_no", target.alias("target"))


def place(documents: DataFrame, workspace: Workspace) -> Placed:
    """Lay the words of each source on a line. ``documents`` has ``doc_id``, ``source``, ``size``, and is read twice.

    A running sum over a source would be one task; documents go to buckets by a hash, and a document's place is the sum
    of the buckets before plus the one within the bucket.
    """
    blocks = F.ceil(F.col("source_size") / F.lit(BLOCK_WORDS))
    length = F.when(blocks > 0, F.ceil(F.col("source_size") / blocks)).otherwise(F.lit(1))
    sources = source_targets(documents).select(
        "*",
        blocks.alias("blocks"),
        length.alias("length"),
        F.ceil(F.col("target") / length).alias("slots"),
        F.ceil(F.col("rows") / F.lit(BUCKET_ROWS)).alias("buckets"),
    )
    sources = sources.withColumn(
        "slots_before", F.sum("slots").over(Window.partitionBy().orderBy("source_no")) - F.col("slots")
    ).withColumn("all_slots", F.sum("slots").over(Window.partitionBy()))
    sources = workspace.save(sources, "sources")
    known = sources.select(F.col("source").alias("_source"), "source_no", "buckets")
    named = documents.join(known, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    bucketed = named.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "size"), "buckets"))
    before = bucketed.groupBy("source_no", "bucket").agg(F.sum("size").alias("words")).select(
        "source_no",
        "bucket",
        (F.sum("words").over(Window.partitionBy("source_no").orderBy("bucket")) - F.col("words")).alias("before"),
    )
    within = Window.partitionBy("source_no", "bucket").orderBy("doc_id", "size").rowsBetween(Window.unboundedPreceding, 0)
    placed = bucketed.withColumn("_upto", F.sum("size").over(within)).join(before, ["source_no", "bucket"])
    start = F.col("before") + F.col("_upto") - F.col("size")
    return Placed(sources, workspace.save(placed.select(*documents.columns, "source_no", start.alias("start")), "placed"))


def slots(sources: DataFrame) -> DataFrame:
    """``(source_no, block, copy, words, shard, place)`` for every slot of the mix.

    ``words`` is how many words of the block are taken: all, but for the last slot of a source, which is trimmed to the
    target. ``copy`` counts how often the block was taken before.
    """
    chunks = sources.where(F.col("slots") > 0).select(
        "*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("slots") - 1, F.lit(CHUNK).cast("long"))).alias("chunk")
    )
    i = F.explode(F.sequence(F.col("chunk"), F.least(F.col("chunk") + CHUNK, F.col("slots")) - 1)).alias("i")
    # A row grows by CHUNK, so tasks must not be merged by the size of what they read.
    tasks = int(sources.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = chunks.repartition(tasks, "source_no", "chunk").select("*", i)
    rest = F.col("target") - F.col("i") * F.col("length")
    place = shuffled(F.col("slots_before") + F.col("i"), F.col("all_slots"), F.lit(-1), invert=True)
    return rows.select(
        "source_no",
        shuffled(F.col("i") % F.col("blocks"), F.col("blocks"), F.col("source_no")).alias("block"),
        F.floor(F.col("i") / F.col("blocks")).alias("copy"),
        F.least(F.col("length"), F.round(rest).cast("long")).alias("words"),
        place.alias("place"),
    ).withColumn("shard", F.floor(F.col("place") / F.lit(SHARD_SLOTS)))


def pieces(placed: Placed) -> DataFrame:
    """``(source_no, start, block, low, high, length)``: which words of a block are those of the document at ``start``.

    A document has one row per block it reaches into.
    """
    lengths = placed.sources.select("source_no", "length")
    spread = placed.documents.where(F.col("size") > 0).select("source_no", "start", "size").join(lengths, "source_no")
    first, last = F.floor(F.col("start") / F.col("length")), F.floor((F.col("start") + F.col("size") - 1) / F.col("length"))
    cut = spread.withColumn("block", F.explode(F.sequence(first, last)))
    begin = F.col("block") * F.col("length")
    return cut.select(
        "source_no",
        "start",
        "block",
        F.greatest(F.col("start") - begin, F.lit(0)).alias("low"),
        F.least(F.col("start") + F.col("size") - begin, F.col("length")).alias("high"),
        "length",
    )


def taken_pieces(placed: Placed) -> DataFrame:
    """``pieces`` joined with the slots that take them; ``high`` is cut where a slot is trimmed."""
    # Both sides grow with the words, whatever their input looks like to the planner.
    joined = pieces(placed).join(slots(placed.sources).hint("merge"), ["source_no", "block"])
    return joined.withColumn("high", F.least("high", "words")).where(F.col("low") < F.col("high"))


def taken_words(placed: Placed) -> DataFrame:
    """``placed.documents`` with ``source_size``, ``target`` and ``taken``."""
    taken = taken_pieces(placed).groupBy("source_no", "start").agg(F.sum(F.col("high") - F.col("low")).alias("taken"))
    known = placed.sources.select("source_no", "source_size", "target")
    taken = taken.withColumn("size_is_set", F.lit(True))
    documents = placed.documents.withColumn("size_is_set", F.col("size") > 0)
    return (
        documents.join(taken, ["source_no", "start", "size_is_set"], "left")
        .join(known, "source_no")
        .withColumn("taken", F.coalesce("taken", F.lit(0)))
        .drop("size_is_set")
    )


def mixed_texts(placed: Placed) -> DataFrame:
    """The mix as documents: the documents' columns, ``copy``, and as ``text`` the words that are taken.

    ``placed.documents`` must have ``text``. A text that is taken whole is left as it is; else its words are joined by
    blanks. Positions are collected per document and copy, one per block of the document's own words.
    """
    begin = F.col("block") * F.col("length") - F.col("start")
    ranges = (
        taken_pieces(placed)
        .groupBy("source_no", "start", F.col("copy"))
        .agg(
            F.sort_array(F.collect_list(F.struct((begin + F.col("low")).alias("a"), (begin + F.col("high")).alias("b")))).alias("ranges"),
            F.sum(F.col("high") - F.col("low")).alias("n"),
        )
    )
    words = F.split(F.regexp_replace("text", r"^[\x20\x09-\x0D]+", ""), r"[\x20\x09-\x0D]+")
    part = F.flatten(F.transform("ranges", lambda r: F.slice(words, (r["a"] + 1).cast("int"), (r["b"] - r["a"]).cast("int"))))
    documents = placed.documents.where(F.col("size") > 0)
    text = F.when(F.col("n") == F.col("size"), F.col("text")).otherwise(F.array_join(part, " "))
    return documents.join(ranges, ["source_no", "start"]).withColumn("text", text).drop("ranges", "n")
