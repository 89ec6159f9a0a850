"""Where query terms occur, and the corpus statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from quillrank.functions.binding import let
from quillrank.operators.lookup import lookup_join
from quillrank.operators.terms import PRESENT
from quillrank.options import RankOptions
from quillrank.workspace import Workspace


def token_counts(tokens: Column) -> Column:
    """``array<struct<token, n>>``: each distinct token and how often it occurs, counted inside the row."""

    def runs(ordered: Column) -> Column:
        places = F.sequence(F.lit(0), F.size(ordered) - 1)
        starts = F.filter(places, lambda i: (i == 0) | (F.get(ordered, i) != F.get(ordered, i - 1)))
        return let(starts, lambda at: F.transform(at, lambda start, i: run(ordered, at, start, i)))

    def run(ordered: Column, at: Column, start: Column, i: Column) -> Column:
        end = F.coalesce(F.get(at, i + 1), F.size(ordered))
        return F.struct(F.get(ordered, start).alias("token"), (end - start).cast("long").alias("n"))

    empty = F.array().cast("array<struct<token:string,n:bigint>>")
    return F.when(F.size(tokens) > 0, let(F.array_sort(tokens), runs)).otherwise(empty)


def with_keys(documents: DataFrame) -> DataFrame:
    return documents.withColumn("doc_key", F.monotonically_increasing_id())


def match_terms(
    documents: DataFrame, dictionary: DataFrame, options: RankOptions, small: bool = True, workspace: Workspace | None = None
) -> DataFrame:
    """``(doc_key, doc_id, doc_len, title, term, tf, is_document)``: a row per query term of a document, or several that
    add up, and one with the title per non-empty document.

    This is the one pass over the text. Tokens are counted before they become rows. All later steps read only these rows.
    A dictionary that is not ``small`` needs ``documents`` to be a written table and a ``workspace``.
    ``doc_key`` tells rows apart whose ids are equal; it holds once the rows are written.
    """
    # The key goes first: it keeps the filter from being pushed down, where it would repeat the analysis.
    keyed = documents if "doc_key" in documents.columns else with_keys(documents)
    rows = keyed.where(F.col("doc_len") > 0)
    on = ["token"]
    no_title = F.lit(None).cast("string").alias("title")

    def entries(tokens: Column, in_body: bool) -> Column:
        return F.transform(
            token_counts(tokens), lambda e: F.struct(e["token"].alias("token"), e["n"].alias("tf"), no_title, F.lit(in_body).alias("in_body"))
        )

    if "in_body" in dictionary.columns:
        on.append("in_body")
        counted = F.concat(entries(F.col("title_tokens"), False), entries(F.col("body_tokens"), True))
    else:
        counted = entries(F.concat("title_tokens", "body_tokens"), False)
    head = F.struct(F.lit(PRESENT).alias("token"), F.lit(0).cast("long").alias("tf"), F.col("title").alias("title"), F.lit(False).alias("in_body"))
    rows = rows.select("doc_key", "doc_id", "doc_len", F.explode(F.concat(F.array(head), counted)).alias("entry"))
    rows = rows.select("doc_key", "doc_id", "doc_len", "entry.*")
    matched = lookup_join(rows, dictionary, on, small, workspace, options.broadcast_bytes)
    return matched.select("doc_key", "doc_id", "doc_len", "title", "term", "tf", (F.col("term") == PRESENT).alias("is_document"))


def matched_documents(matches: DataFrame) -> DataFrame:
    """``(doc_key, doc_id, doc_len, title)``, one row per non-empty document."""
    return matches.where("is_document").select("doc_key", "doc_id", "doc_len", "title")


def hits(matches: DataFrame) -> DataFrame:
    """``(doc_key, doc_id, doc_len, term, tf)``; rows of one document and term add up."""
    return matches.where(~F.col("is_document")).select("doc_key", "doc_id", "doc_len", "term", "tf")


def corpus_stats(documents: DataFrame) -> DataFrame:
    """One row ``(n_docs, total_len, avg_len)`` over non-empty documents.

    Empty documents are not filtered out but not counted: a filter would move below the analysis and
    repeat it.
    """
    return documents.agg(
        F.count_if(F.col("doc_len") > 0).alias("n_docs"), F.sum(F.col("doc_len").cast("long")).alias("total_len")
    ).select("n_docs", "total_len", F.try_divide("total_len", "n_docs").alias("avg_len"))


def term_frequencies(hits: DataFrame, tasks: int | None = None) -> DataFrame:
    """``(doc_key, doc_id, doc_len, term, tf)``, in ``tasks`` partitions or as many as its bytes ask for.

    Hits are shuffled by document alone. Scoring groups by document too, so it needs no second shuffle.
    """
    dealt = hits.repartition(tasks, "doc_key") if tasks else hits.repartition("doc_key")
    return dealt.groupBy("doc_key", "doc_id", "doc_len", "term").agg(F.sum("tf").alias("tf"))


def term_statistics(hits: DataFrame, stats: DataFrame) -> DataFrame:
    """``(term, cf, n_docs, avg_len)``: all that scoring needs to know about a term, one row per query term."""
    return collection_tf(hits).select(
        "term", "cf", *[stats.select(name).scalar().alias(name) for name in ("n_docs", "avg_len")]
    )


def collection_tf(hits: DataFrame) -> DataFrame:
    """``(term, cf)``: occurrences of each query term in the corpus, summed before the shuffle."""
    return hits.groupBy("term").agg(F.sum("tf").alias("cf"))
