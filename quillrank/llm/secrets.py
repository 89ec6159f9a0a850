"""Secret scans: fixed patterns, and character Markov models for what the patterns miss.

Patterns label the samples, over the whole corpus. What the secret patterns find are random strings; long runs of the same
characters that are written like words are ordinary identifiers. Of both, first-order transitions are counted. In every run the
stretches that the random model explains better by a limit (natural log) are reported, widened to the separators around them.
Under the ordinary model a stretch from a given character on ever gains t with a chance of exp(-t) at most (the ratio has a mean of
one), so in n characters one does with n * exp(-t). The limit log(n / ``CHANCE``) keeps that at ``CHANCE`` for runs of all
lengths. It depends on the run alone, not on the size of the corpus. Only built-in expressions are used. The models are one number per pair
of characters, which the driver sees.

Defined cases: a null text is an empty one; a corpus without any pattern match has no random model and gets no further
spans; runs of digits alone are numbers and not reported; repeated rows are each scanned; further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# The patterns, and how long a value must be.
ASSIGN = (
    r"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]"""
    r"""|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ASSIGN_VALUE = 6
ACCESS = "AKIA[A-Z0-9]{16,}"
HEX = "[0-9a-f]{24,}"
KINDS = ("assign", "access", "hex", "random")

LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
RUN = 16  # characters of a run that is scored
SAMPLE_RUN = 12  # and of one that is learned from as ordinary
CHANCE = 0.001  # share of ordinary runs, as the model has them, that may hold a stretch which is reported
# What is learned from as ordinary: words in one of the usual cases, joined, with a short number at most.
ORDINARY = r"^[+/_=-]*+(?:(?:[A-Z]?[a-z]++|[A-Z]++)[+/_=-]*+)++[0-9]{0,4}+[+/_=-]*+$"
SMOOTHING = 0.5
UNIFORM = 0.3  # share of the random model that takes all characters alike


def located(text: Column, pattern: str, kind: str, value: int = 0, least: int = 1) -> Column:
    """Matches of ``pattern`` as ``array<struct<start, kind, end, value>>``, in code points; ``kind`` by number.

    Only matches whose group ``value`` has ``least`` characters are kept. A place is what lies before: the texts
    between the matches, and the matches.
    """
    code = KINDS.index(kind)
    empty = F.array().cast("array<struct<start:long,kind:int,end:long,value:string>>")
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(value))
    rows = F.zip_with(
        F.arrays_zip(matches.alias("match"), values.alias("value")),
        F.transform(F.split(text, pattern, -1), lambda gap: F.length(gap)),
        lambda m, gap: F.struct(m["match"].alias("match"), m["value"].alias("value"), gap.alias("gap")),
    )

    def step(state: Column, row: Column) -> Column:
        start = state["at"] + row["gap"]
        end = start + F.length(row["match"])
        span = F.struct(start.alias("start"), F.lit(code).alias("kind"), end.alias("end"), row["value"].alias("value"))
        keep = F.length(row["value"]) >= least
        return F.struct(end.alias("at"), F.when(keep, F.array_append(state["found"], span)).otherwise(state["found"]).alias("found"))

    start = F.struct(F.lit(0).cast("long").alias("at"), empty.alias("found"))
    # The last text between matches has no match after it.
    found = F.aggregate(F.filter(rows, lambda row: row["match"].isNotNull()), start, step, lambda state: state["found"])
    return F.when(text.rlike(pattern), found).otherwise(empty)


def base_spans(text: Column) -> Column:
    """What the patterns find, by start and kind. ``value`` is the secret itself."""
    return F.array_sort(
        F.concat(
            located(text, ASSIGN, "assign", value=2, least=ASSIGN_VALUE),
            located(text, ACCESS, "access"),
            located(text, HEX, "hex"),
        )
    )


def _apart(runs: Column, base: Column) -> Column:
    """What of ``runs`` lies outside the spans of ``base``, in pieces of at least ``SAMPLE_RUN`` characters."""

    def pieces(run: Column) -> Column:
        def piece(low: Column, high: Column) -> Column:
            value = F.substr(run["value"], (low - run["start"] + 1).cast("int"), (high - low).cast("int"))
            return F.struct(low.alias("start"), run["kind"].alias("kind"), high.alias("end"), value.alias("value"))

        def add(s: Column, high: Column) -> Column:
            return F.when(high - s["at"] >= SAMPLE_RUN, F.array_append(s["found"], piece(s["at"], high))).otherwise(s["found"])

        def step(s: Column, b: Column) -> Column:
            return F.struct(F.greatest(s["at"], b["end"]).alias("at"), add(s, b["start"]).alias("found"))

        touching = F.filter(base, lambda b: (b["start"] < run["end"]) & (run["start"] < b["end"]))
        none = F.array().cast("array<struct<start:long,kind:int,end:long,value:string>>")
        cut = F.aggregate(touching, F.struct(run["start"].alias("at"), none.alias("found")), step, lambda s: add(s, run["end"]))
        return F.when(F.size(touching) == 0, F.array(run)).otherwise(cut)

    return F.flatten(F.transform(runs, pieces))


def _run_pattern(least: int) -> str:
    return f"[A-Za-z0-9+/_=-]{{{least},}}"


def _codes(text: Column) -> Column:
    """Numbers of the characters in ``LETTERS``, from 0; -1 for others."""
    return F.transform(F.split(text, ""), lambda c: F.instr(F.lit(LETTERS), c) - 1)


def with_base_spans(documents: DataFrame) -> DataFrame:
    """``(doc_id, base, runs)``: pattern spans, and the ordinary-looking runs of at least ``SAMPLE_RUN`` characters."""
    text = F.coalesce(F.col("text"), F.lit(""))
    found = documents.select("doc_id", base_spans(text).alias("base"), located(text, _run_pattern(SAMPLE_RUN), "random").alias("runs"))
    return found.select("doc_id", "base", _apart(F.col("runs"), F.col("base")).alias("runs"))


def transitions(found: DataFrame) -> DataFrame:
    """``(random, a, b, n)``: how often character b follows a, in the samples of either label."""
    sample = lambda spans, label: F.transform(spans, lambda s: F.struct(F.lit(label).alias("random"), s["value"].alias("value")))
    ordinary = F.filter("runs", lambda run: run["value"].rlike(ORDINARY))
    samples = found.select(F.explode(F.concat(sample("base", True), sample(ordinary, False))).alias("s")).select("s.*")
    codes = samples.select("random", _codes(F.col("value")).alias("codes"))
    # One number per pair, so that the rows that are counted are small.
    pairs = F.zip_with(
        F.slice("codes", 1, F.size("codes") - 1), F.slice("codes", 2, F.size("codes")), lambda a, b: F.when((a >= 0) & (b >= 0), a * len(LETTERS) + b)
    )
    counted = codes.select("random", F.explode(pairs).alias("pair")).where(F.col("pair").isNotNull())
    return counted.groupBy("random", "pair").agg(F.count(F.lit(1)).alias("n"))


def log_ratios(found: DataFrame) -> list[float] | None:
    """``log P(b after a | random) - log P(b after a | ordinary)`` for all pairs of ``LETTERS``; None without samples."""
    size = len(LETTERS)
    spark = found.sparkSession
    counts = transitions(found).groupBy("pair").pivot("random", [True, False]).agg(F.sum("n"))
    counts = counts.select("pair", *[F.coalesce(F.col(f"`{label}`"), F.lit(0)).alias(name) for label, name in (("true", "r"), ("false", "o"))])
    grid = spark.range(size * size).select(F.col("id").alias("pair")).join(counts, "pair", "left").na.fill(0)
    first = F.floor(F.col("pair") / size)
    totals = grid.groupBy(first.alias("first")).agg(F.sum("r").alias("all_r"), F.sum("o").alias("all_o"))

    def share(n: str, total: str) -> Column:
        return (F.col(n) + SMOOTHING) / (F.col(total) + SMOOTHING * size)

    random = share("r", "all_r") * (1 - UNIFORM) + F.lit(UNIFORM / size)
    rows = grid.withColumn("first", first).join(totals, "first").select("pair", "r", F.log(random / share("o", "all_o")).alias("ratio")).collect()
    if not any(row["r"] for row in rows):
        return None
    return [row["ratio"] for row in sorted(rows)]


def _table(ratios: list[float]) -> Column:
    return F.split(F.lit(" ".join(f"{x:.6f}" for x in ratios)), " ").cast("array<double>")  # folded into one literal


def _ratios(value: Column, table: Column) -> Column:
    """Log ratios of the pairs of characters of ``value``, in order."""
    codes = _codes(value)
    return F.zip_with(
        F.slice(codes, 1, F.length(value) - 1), F.slice(codes, 2, F.length(value)), lambda a, b: F.get(table, (a * len(LETTERS) + b).cast("int"))
    )


def _stretches(ratios: Column, limit: Column) -> Column:
    """``array<struct<a, b>>``: characters of the best stretches that reach ``limit``, apart from each other.

    A stretch grows until its sum is no longer positive or ``limit`` below its peak, and ends at the peak. What lies between
    there and the next start holds no stretch that reaches ``limit``.
    """
    zero, none = F.lit(0), F.array().cast("array<struct<a:int,b:int>>")
    state = F.struct(
        zero.alias("at"), F.lit(0.0).alias("now"), zero.alias("a"), F.lit(0.0).alias("peak"), zero.alias("b"), none.alias("found")
    )

    def reported(s: Column) -> Column:
        return F.when(s["peak"] >= limit, F.array_append(s["found"], F.struct(s["a"].alias("a"), s["b"].alias("b")))).otherwise(s["found"])

    def step(s: Column, x: Column) -> Column:
        now = s["now"] + x
        over = (now <= 0) | (s["peak"] - now >= limit)
        higher = now > s["peak"]
        return F.struct(
            (s["at"] + 1).alias("at"),
            F.when(over, F.lit(0.0)).otherwise(now).alias("now"),
            F.when(over, s["at"] + 1).otherwise(s["a"]).alias("a"),
            F.when(over, F.lit(0.0)).when(higher, now).otherwise(s["peak"]).alias("peak"),
            F.when(higher, s["at"] + 2).otherwise(s["b"]).alias("b"),
            F.when(over, reported(s)).otherwise(s["found"]).alias("found"),
        )

    return F.aggregate(ratios, state, step, reported)


def _widened(run: Column, stretch: Column) -> Column:
    """The span of a stretch of ``run``, with what belongs to it up to the next separator, and padding."""
    value = run["value"]
    inside = F.substr(value, stretch["a"] + 1, stretch["b"] - stretch["a"])
    first = stretch["a"] + F.length(F.regexp_extract(inside, "^[/_=-]*", 0))
    last = stretch["b"] - F.length(F.regexp_extract(inside, "[/_-]*$", 0))
    low = first - F.length(F.regexp_extract(F.substr(value, F.lit(1), first), "[A-Za-z0-9+]*$", 0))
    high = last + F.length(F.regexp_extract(F.substr(value, last + 1), "^[A-Za-z0-9+]*=*", 0))
    return F.struct(
        (run["start"] + low).alias("start"),
        run["kind"].alias("kind"),
        (run["start"] + high).alias("end"),
        F.substr(value, low + 1, high - low).alias("value"),
    )


def scan(found: DataFrame, ratios: list[float] | None, chance: float = CHANCE) -> DataFrame:
    """``(doc_id, base, spans)`` from ``with_base_spans``; ``spans`` are those of ``base`` and the added ones, in order."""
    if ratios is None:
        return found.select("doc_id", "base", F.col("base").alias("spans"))
    table = _table(ratios)

    def secrets(run: Column) -> Column:
        limit = F.log(F.length(run["value"]) / F.lit(chance))
        inside = F.transform(_stretches(_ratios(run["value"], table), limit), lambda stretch: _widened(run, stretch))
        return F.array_distinct(F.filter(inside, lambda s: (F.length(s["value"]) >= RUN) & s["value"].rlike("[A-Za-z]")))

    long = F.filter("runs", lambda run: (F.length(run["value"]) >= RUN) & ~run["value"].rlike("^[0-9]+$"))
    return found.select("doc_id", "base", F.array_sort(F.concat("base", F.flatten(F.transform(long, secrets)))).alias("spans"))


def listed(spans: Column) -> Column:
    """``kind:start:end``, joined by commas."""
    names = F.array(*[F.lit(kind) for kind in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")


def count_kind(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == KINDS.index(kind))).cast("long")


def redacted(text: Column, spans: Column) -> Column:
    """``text`` with every span replaced by ``*``; ``spans`` are sorted by start."""
    state = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out"))

    def step(s: Column, span: Column) -> Column:
        gap = F.substr(text, (s["at"] + 1).cast("int"), F.greatest(span["start"] - s["at"], F.lit(0)).cast("int"))
        star = F.when(span["end"] > s["at"], F.lit("*")).otherwise(F.lit(""))
        return F.struct(F.greatest(s["at"], span["end"]).alias("at"), F.concat(s["out"], gap, star).alias("out"))

    return F.aggregate(spans, state, step, lambda s: F.concat(s["out"], F.substr(text, (s["at"] + 1).cast("int"))))
