"""Shards cut from the order of a Hilbert curve through quantised metadata.

Rows that are close in all dimensions are close on the curve, so a run of the order covers a small box of every
dimension and a reader that filters on any of them can skip most shards. Everything is built-in expressions; the only
shuffle is the range partitioning of the sort.

Defined cases: a null text has no bytes and the checksum of an empty one, a null dimension is quantised to 0, rows
that are equal in every sort key take the order in which they are read. Columns that are not asked for are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from quillrank.workspace import Workspace

SHARDS = 24
BITS = 6  # of each dimension
_PER_PARTITION = 33  # bits that monotonically_increasing_id() leaves for the row


def bit(value: Column, place: Column | int) -> Column:
    place = F.lit(place) if isinstance(place, int) else place
    return F.call_function("shiftright", value, place.cast("int")).bitwiseAND(F.lit(1).cast("long"))


def hilbert_index(dimensions: list[Column], bits: int = BITS) -> Column:
    """Place on the Hilbert curve through the cube of ``dimensions``, whole numbers below ``2 ** bits``.

    Skilling's transformation: from the highest bit down, a set bit of a dimension inverts the lower bits of the
    first one, an unset bit exchanges them; what is left is Gray coded and interleaved.
    """
    n = len(dimensions)
    steps = F.array(
        *[F.struct(F.lit(1 << b).cast("long").alias("q"), F.lit(i).alias("i")) for b in range(bits - 1, 0, -1) for i in range(n)]
    )

    def turn(x: Column, step: Column) -> Column:
        first, own, low = x[0], F.get(x, step["i"]), step["q"] - 1
        is_set = own.bitwiseAND(step["q"]) != 0
        swap = F.when(is_set, F.lit(0).cast("long")).otherwise(first.bitwiseXOR(own).bitwiseAND(low))
        new_first = F.when(is_set, first.bitwiseXOR(low)).otherwise(first.bitwiseXOR(swap))
        return F.transform(x, lambda v, i: F.when(i == 0, new_first).when(i == step["i"], v.bitwiseXOR(swap)).otherwise(v))

    turned = F.aggregate(steps, F.array(*[d.cast("long") for d in dimensions]), turn)
    # x[i] becomes x[0] ^ ... ^ x[i]
    gray = F.transform(
        turned, lambda _, i: F.aggregate(F.slice(turned, 1, i + 1), F.lit(0).cast("long"), lambda a, b: a.bitwiseXOR(b))
    )

    def interleaved(x: Column) -> Column:
        places = F.array(*[F.lit(b) for b in range(bits - 1, 0, -1)])
        flip = F.aggregate(
            places, F.lit(0).cast("long"), lambda t, b: t.bitwiseXOR(bit(x[n - 1], b) * (F.call_function("shiftleft", F.lit(1).cast("long"), b) - 1))
        )
        flipped = F.transform(x, lambda v: v.bitwiseXOR(flip))
        order = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(b).alias("b")) for b in range(bits - 1, -1, -1) for i in range(n)])
        return F.aggregate(order, F.lit(0).cast("long"), lambda out, o: out * 2 + bit(F.get(flipped, o["i"]), o["b"]))

    # An array of one element, so that the argument is evaluated once.
    return F.transform(F.array(gray), interleaved)[0]


def by_hash(value: Column, bits: int = BITS) -> Column:
    """A cell for a name: equal names share one."""
    return F.coalesce(F.pmod(F.crc32(value.cast("binary")), F.lit(1 << bits)), F.lit(0))


def by_magnitude(value: Column, bits: int = BITS) -> Column:
    """A cell for a whole number from 0 on: two for every doubling."""
    digits = F.bin(value)
    cell = 2 * F.length(digits) + F.substring(digits, 2, 1).eqNullSafe("1").cast("int")
    return F.coalesce(F.least(cell, F.lit((1 << bits) - 1)), F.lit(0))


def sharded(frame: DataFrame, order: list[Column], workspace: Workspace, shards: int = SHARDS) -> DataFrame:
    """``frame`` with ``shard`` and ``slot``: runs of equal length (at most one row apart) of ``order``.

    ``frame`` must not have columns of these names, nor ``_row``, ``_part`` and ``_before``. Ranks need no single
    task: the sorted partitions are numbered and counted, and a rank is what lies before the partition plus the
    place in it. The counts are one row per partition.
    """
    ties = [*order, F.col("_row")]
    ordered = frame.withColumn("_row", F.monotonically_increasing_id()).repartitionByRange(*ties).sortWithinPartitions(*ties)
    ranked = workspace.save(ordered.withColumn("_row", F.monotonically_increasing_id()), "ordered")
    part = F.shiftright("_row", _PER_PARTITION)
    counts = ranked.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("n"))
    before = counts.select(
        "_part",
        (F.sum("n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, 0)) - F.col("n")).alias("_before"),
        F.sum("n").over(Window.partitionBy()).alias("_total"),
    )
    placed = ranked.withColumn("_part", part).join(F.broadcast(before), "_part")
    placed = placed.withColumn("_rank", F.col("_before") + F.col("_row").bitwiseAND(F.lit((1 << _PER_PARTITION) - 1)))
    shard = F.expr(f"(_rank * {shards}) div _total")
    return placed.select(
        *[F.col(f"`{name}`") for name in frame.columns],
        shard.cast("int").alias("shard"),
        (F.col("_rank") - F.expr(f"(((_rank * {shards}) div _total) * _total + {shards - 1}) div {shards}")).alias("slot"),
    )


def text_bytes(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long")


def text_crc32(text: Column) -> Column:
    return F.coalesce(F.crc32(text.cast("binary")), F.lit(0).cast("long"))


def document_order() -> list[Column]:
    """Sort keys for documents: the curve through source, language and length, then the text's checksum and the id."""
    size = text_bytes(F.col("text"))
    curve = hilbert_index([by_hash(F.col("source")), by_hash(F.col("lang")), by_magnitude(size)])
    return [curve.alias("hilbert"), text_crc32(F.col("text")).alias("text_crc32"), size.alias("text_bytes"), F.col("doc_id")]


def write_shards(placed: DataFrame, path: str) -> None:
    """One folder per shard, rows in order."""
    placed.repartition("shard").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)


def shard_boxes(placed: DataFrame, dimensions: list[str]) -> DataFrame:
    """Smallest and largest value of each dimension per shard: what a reader prunes by."""
    ends = [f(name).alias(f"{prefix}_{name}") for name in dimensions for f, prefix in ((F.min, "min"), (F.max, "max"))]
    return placed.groupBy("shard").agg(F.count(F.lit(1)).alias("rows"), *ends)
