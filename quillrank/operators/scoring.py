"""Term scores and document scores."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from quillrank.functions.weighting import dph
from quillrank.operators.lookup import lookup_join
from quillrank.options import RankOptions
from quillrank.workspace import Workspace

TASK_ROWS = 1 << 19  # of ``query_term_scores`` that a task makes and adds up


def posting_scores(
    postings: DataFrame, statistics: DataFrame, options: RankOptions, small: bool = True, workspace: Workspace | None = None
) -> DataFrame:
    """``(doc_key, doc_id, doc_len, term, tf, cf, term_score)``.

    A term's score in a document is the same for all queries, so it is computed before queries are joined.
    """
    score = dph(*[F.col(name) for name in ("tf", "cf", "doc_len", "avg_len", "n_docs")], options.ratio)
    return lookup_join(postings, statistics, ["term"], small, workspace, options.broadcast_bytes).select(
        "doc_key", "doc_id", "doc_len", "term", "tf", "cf", score.alias("term_score")
    )


def query_shares(terms: DataFrame) -> DataFrame:
    """``(query_id, term, share)``: the part of a query's terms, repeated ones counted, that is ``term``."""
    return terms.groupBy("query_id", "term").agg((F.count(F.lit(1)) / F.max("n_terms")).alias("share"))


def scoring_tasks(hits: DataFrame, shares: DataFrame) -> int:
    """How many tasks make at most about ``TASK_ROWS`` rows each, a row for every hit and query that holds its term; no fewer than cores.

    Hits are shuffled before queries are joined, when they are a small part of these rows, so the bytes of the shuffle do not tell
    what a task will hold.
    """
    met = hits.groupBy("term").agg(F.count(F.lit(1)).alias("n"))
    asked = shares.groupBy("term").agg(F.count(F.lit(1)).alias("n_queries"))
    rows = met.join(asked, "term").agg(F.sum(F.col("n") * F.col("n_queries"))).first()[0] or 0
    return max(hits.sparkSession.sparkContext.defaultParallelism, -(-rows // TASK_ROWS))


def query_term_scores(
    scored: DataFrame, shares: DataFrame, options: RankOptions, small: bool = True, workspace: Workspace | None = None
) -> DataFrame:
    """``scored`` once for every query that holds the term, with ``query_id`` and ``share``."""
    return lookup_join(scored, shares, ["term"], small, workspace, options.broadcast_bytes)


def document_scores(term_scores: DataFrame, options: RankOptions) -> DataFrame:
    """``(query_id, doc_key, doc_id, score)``: term scores averaged over all terms of the query, repeated
    and unmatched ones included."""
    mean = F.sum(F.col("share") * F.col("term_score"))
    return term_scores.groupBy("query_id", "doc_key", "doc_id").agg(
        F.round(mean, options.score_digits).alias("score")
    )
