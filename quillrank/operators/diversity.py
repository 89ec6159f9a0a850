"""The k best documents of a query whose titles are not near-duplicates.

Going down a query's ranking, a document is kept if its title is far from the titles of all documents kept
before it, until k are kept. How far down that leads is not known beforehand: a third of the corpus may
carry one title. So it goes in rounds. The first takes the ``depth`` best candidates of every query and
walks over them inside the row; nearly always that is enough. Queries still short of k go on with a window
of the next candidates, ten times wider each round. Those alike to a kept title drop out in parallel, each
on its own, and the walk continues over the best ``depth`` of the others. Every round either keeps a
document or uses up its window, so the rounds number at most k plus the logarithm of the longest ranking,
and no task ever holds more than ``depth`` candidates of a query.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from quillrank.functions.titles import titles_alike
from quillrank.operators.ranking import first_per_query, rank_all, top_per_query
from quillrank.options import RankOptions
from quillrank.workspace import Measured, Workspace

ENTRY = ("doc_id", "doc_key", "title", "score")
TOP_ROW_BYTES = 64  # query_id, doc_key, score and position
UNCOUNTED = 1 << 62  # more candidates than any query has


def no_selection(queries: DataFrame, scores: DataFrame, documents: DataFrame) -> DataFrame:
    """``(query_id, kept)`` with nothing kept; the other arguments give the types of an entry."""
    types = {**dict(documents.dtypes), **dict(scores.dtypes)}
    entry = ",".join(f"{name}:{types[name]}" for name in ENTRY)
    return queries.select("query_id", F.array().cast(f"array<struct<{entry}>>").alias("kept"))


def _alike_any(kept: Column, title: Column, options: RankOptions) -> Column:
    """Whether ``title`` is alike to a kept one. Equal titles are looked for first: that is cheap, and
    copies are what there is most of."""
    equal = F.exists(kept, lambda entry: (entry["title"] == title) & (title != ""))
    return F.when(equal & F.lit(options.min_title_distance > 0), F.lit(True)).otherwise(
        F.exists(kept, lambda entry: titles_alike(entry["title"], title, options.min_title_distance))
    )


def _walk(kept: Column, candidates: Column, options: RankOptions) -> Column:
    def step(kept, candidate):
        full = F.size(kept) >= options.k
        return F.when(full, kept).when(_alike_any(kept, candidate["title"], options), kept).otherwise(
            F.array_append(kept, F.struct(*[candidate[name].alias(name) for name in ENTRY]))
        )

    return F.aggregate(candidates, kept, step)


def _round(state: DataFrame, titled: DataFrame, window: int, options: RankOptions, n_queries: int) -> DataFrame:
    """``state``: ``(query_id, kept, decided, total)``, where candidates up to position ``decided`` of
    ``total`` are settled. ``titled``: per query the first ``depth`` candidates of the next ``window`` that
    are not settled."""
    candidates = titled.select(
        "query_id", F.struct(F.col("position").cast("long").alias("position"), *ENTRY).alias("candidate")
    )
    # Few bytes and much work per query: a fixed number of partitions keeps them from being packed together.
    tasks = max(1, min(n_queries, int(state.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    pools = (
        state.unionByName(candidates, allowMissingColumns=True)
        .repartition(tasks, "query_id")
        .groupBy("query_id")
        .agg(
            *[F.any_value(name, F.lit(True)).alias(name) for name in ("kept", "decided", "total")],
            F.array_sort(F.collect_list("candidate")).alias("pool"),
        )
    )
    cut = F.size("pool") == options.depth
    return pools.select(
        "query_id",
        _walk(F.col("kept"), F.col("pool"), options).alias("kept"),
        F.when(cut, F.try_element_at("pool", F.lit(-1))["position"])
        .otherwise(F.least(F.col("decided") + window, F.col("total")))
        .alias("decided"),
        "total",
    ).withColumn("open", (F.size("kept") < options.k) & (F.col("decided") < F.col("total")))


def with_titles(rows: DataFrame, documents: DataFrame, most_rows: int, options: RankOptions) -> DataFrame:
    """Ids and titles come from ``documents``, so the other side is of fixed width; it has at most ``most_rows``."""
    rows = rows.select("query_id", "doc_key", "score", "position")
    small = most_rows * TOP_ROW_BYTES <= options.broadcast_bytes
    return documents.select("doc_key", "doc_id", "title").join(F.broadcast(rows) if small else rows, "doc_key")


def _undecided(ranked: DataFrame, state: Measured, window: int, documents: DataFrame, options: RankOptions) -> DataFrame:
    """The candidates of the next ``window`` that are not alike to a kept title, the first ``depth`` per query."""

    def of_query(rows: DataFrame, *columns: str) -> DataFrame:
        unfinished = state.frame.where("open").select("query_id", *columns)
        return rows.join(F.broadcast(unfinished) if state.fits(options.broadcast_bytes) else unfinished, "query_id")

    next_ones = of_query(ranked, "decided").where(
        (F.col("position") > F.col("decided")) & (F.col("position") <= F.col("decided") + window)
    )
    titled = of_query(with_titles(next_ones, documents, state.observed["n_open"] * window, options), "kept")
    others = titled.where(~_alike_any(F.col("kept"), F.col("title"), options))
    return first_per_query(others, options.depth, [F.asc("position")], "place")


def extend_selection(
    selection: DataFrame,
    candidates: DataFrame,
    documents: DataFrame,
    options: RankOptions,
    workspace: Workspace,
    n_queries: int,
) -> DataFrame:
    """Continue ``selection`` with ``candidates`` ``(query_id, doc_key, doc_id, score)``, all of which rank
    below what is already kept. Returns ``(query_id, kept)``."""

    def save(state: DataFrame) -> Measured:
        return workspace.save_measured(state, "selection", n_open=F.count_if("open"))

    # How many candidates there are is only counted for queries that need more than the first ones.
    start = selection.select(
        "query_id", "kept", F.lit(0).cast("long").alias("decided"), F.lit(UNCOUNTED).cast("long").alias("total")
    )
    top = with_titles(top_per_query(candidates, options.depth), documents, n_queries * options.depth, options)
    state = save(_round(start, top, UNCOUNTED, options, n_queries))
    finished = [state.frame.where(~F.col("open"))]
    ranked, window = None, options.depth
    while state.observed["n_open"]:
        unfinished = state.frame.where("open").select("query_id", "kept", "decided", "total")
        n_open = state.observed["n_open"]
        window *= 10
        if ranked is None:
            left = workspace.save(candidates.join(unfinished.select("query_id"), "query_id", "left_semi"), "candidates")
            ranked = workspace.save(rank_all(left, options, workspace), "ranked")
            counts = ranked.groupBy("query_id").agg(F.max("position").alias("total"))
            unfinished = unfinished.drop("total").join(counts, "query_id")
        others = _undecided(ranked, state, window, documents, options)
        state = save(_round(unfinished, others, window, options, n_open))
        finished.append(state.frame.where(~F.col("open")))
    return reduce(DataFrame.union, [part.select("query_id", "kept") for part in finished])


def near_duplicate_titles(ranked: DataFrame, options: RankOptions) -> DataFrame:
    """Pairs of alike titles among the ``position`` 1..k rows of every query, at most k(k-1)/2 of them."""
    top = ranked.groupBy("query_id").agg(
        F.array_sort(F.collect_list(F.struct("position", "doc_id", "title"))).alias("top")
    )
    upper = top.select("query_id", "top", F.explode("top").alias("a"))
    lower = F.filter(
        "top",
        lambda b: (b["position"] > F.col("a.position"))
        & titles_alike(F.col("a.title"), b["title"], options.min_title_distance),
    )
    return upper.select("query_id", "a", F.explode(lower).alias("b")).select(
        "query_id",
        F.col("a.doc_id").alias("doc_id"),
        F.col("b.doc_id").alias("other_id"),
        F.col("a.title").alias("title"),
        F.col("b.title").alias("other_title"),
    )
