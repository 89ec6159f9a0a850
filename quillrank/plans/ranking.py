"""From articles and queries to a ranking."""

from __future__ import annotations

from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from quillrank.operators.diversity import extend_selection, no_selection
from quillrank.operators.documents import analyze_documents
from quillrank.operators.matching import (
    corpus_stats, hits, match_terms, matched_documents, term_frequencies, term_statistics, with_keys,
)
from quillrank.operators.ranking import numbered
from quillrank.operators.scoring import document_scores, posting_scores, query_shares, query_term_scores, scoring_tasks
from quillrank.operators.stopwords import read_words, without_listed_stems, without_words
from quillrank.operators.terms import (
    kept_stem_vocabulary, plain_dictionary, query_tokens, stem_vocabulary, stemmed_dictionary, token_terms, vocabulary,
)
from quillrank.options import RankOptions
from quillrank.sources.articles import RANKED_FIELDS, read_articles, read_with_rejects
from quillrank.sources.queries import distinct_queries, read_queries
from quillrank.workspace import Measured, Workspace


SPAN = 1024  # numbers of documents that are counted together


@dataclass(frozen=True)
class Match:
    """The corpus cut down to what the queries need, on disk."""

    queries: Measured  # query_id, query
    terms: Measured  # query_id, pos, term, n_terms
    matches: DataFrame  # see match_terms
    options: RankOptions
    workspace: Workspace

    @property
    def documents(self) -> DataFrame:
        return matched_documents(self.matches)

    @property
    def hits(self) -> DataFrame:
        return hits(self.matches)

    @property
    def postings(self) -> DataFrame:
        return term_frequencies(self.hits)

    @property
    def stats(self) -> DataFrame:
        return corpus_stats(self.documents)

    @property
    def term_scores(self) -> DataFrame:
        # Neither lookup side has more rows, or wider ones, than the measured query terms.
        small = self.terms.fits(self.options.broadcast_bytes)
        shares = query_shares(self.terms.frame)
        if small:
            # All up to the scores happens in the partitions of this shuffle.
            postings = term_frequencies(self.hits, scoring_tasks(self.hits, shares))
        else:
            postings = self.workspace.save(self.postings, "postings")
        statistics = term_statistics(self.hits, self.stats)
        scored = posting_scores(postings, statistics, self.options, small, self.workspace)
        if not small:
            scored = self.workspace.save(scored, "term-scores")
        return query_term_scores(scored, shares, self.options, small, self.workspace)

    @property
    def scores(self) -> DataFrame:
        return document_scores(self.term_scores, self.options)


def match_corpus(articles: DataFrame, queries: DataFrame, options: RankOptions, workspace: Workspace) -> Match:
    """Analyze queries and articles and write where the query terms occur."""
    listed = None
    if options.stopword_table:
        listed = workspace.save(read_words(articles.sparkSession, options.stopword_table), "stop-words")
        options = replace(options, stopwords=())
    asked = workspace.save_measured(distinct_queries(queries), "queries")
    tokens = query_tokens(asked.frame, options)
    if listed is not None:
        tokens = without_words(workspace.save(tokens, "query-tokens"), "query_id", ["tokens"], listed, options, workspace)
    terms = workspace.save_measured(token_terms(tokens, options), "terms")
    documents = analyze_documents(articles, options)
    plain_fits = terms.fits(options.broadcast_bytes)
    if listed is not None:
        documents = workspace.save(with_keys(documents), "all-tokens")
        documents = without_words(documents, "doc_key", ["title_tokens", "body_tokens"], listed, options, workspace)
        documents = workspace.save(documents.withColumn("doc_len", F.size("title_tokens") + F.size("body_tokens")), "tokens")
    elif options.stem or not plain_fits:
        # Read more than once, for the vocabulary or for hot terms, and for the match. The tokens of titles and leading
        # paragraphs are smaller than the articles and need no second parse.
        documents = workspace.save(with_keys(documents), "tokens")
    if options.stem:
        words = vocabulary(documents)
        if options.stem_table:
            words = kept_stem_vocabulary(words, options.stem_table, options, workspace)
        else:
            words = stem_vocabulary(words, options)
        if listed is not None and options.body_passes == 2:
            words = without_listed_stems(words, listed)
        stems = workspace.save_measured(stemmed_dictionary(words, terms.frame, options), "dictionary")
        dictionary, small = stems.frame, stems.fits(options.broadcast_bytes)
    else:
        dictionary, small = plain_dictionary(terms.frame), plain_fits
    matches = workspace.save(match_terms(documents, dictionary, options, small, workspace), "matches", by="is_document")
    return Match(asked, terms, matches, options, workspace)


def unmatched(taken: DataFrame, short: DataFrame, n_documents: int, low: int, high: int) -> DataFrame:
    """``(query_id, number)``: the ``low`` + 1-th to ``high``-th of the documents, numbered from 1 to ``n_documents``, that
    a query in ``short`` has no row for in ``taken`` ``(query_id, number)``.

    Between two numbers that a query has lie the ones it lacks, and the number less its row number counts them. Counts
    per ``SPAN`` numbers say first how far a query must look, so only its rows up to there are put in order.
    """
    span = F.floor((F.col("number") - 1) / SPAN)
    counts = taken.join(short.select("query_id"), "query_id", "left_semi").groupBy("query_id", span.alias("span")).agg(F.count(F.lit(1)).alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("query_id").orderBy("span").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    begun = counts.withColumn("before", before).where(F.col("span") * SPAN - F.col("before") < high)
    last = begun.groupBy("query_id").agg(F.max(F.struct("span", "before", "n")).alias("last"))
    end = (F.col("last.span") + 1) * SPAN
    free = end - F.col("last.before") - F.col("last.n")  # up to the end of the last span that was begun
    far = F.coalesce(end + F.greatest(high - free, F.lit(0)), F.lit(high))
    reach = short.select("query_id").join(last, "query_id", "left").select("query_id", F.least(far, F.lit(n_documents)).alias("reach"))

    within = taken.join(reach, "query_id").where(F.col("number") <= F.col("reach")).select("query_id", "number")
    closed = within.union(reach.select("query_id", F.col("reach") + 1))
    order = Window.partitionBy("query_id").orderBy("number")
    gaps = closed.select(
        "query_id", "number", F.row_number().over(order).alias("row"), F.coalesce(F.lag("number").over(order), F.lit(0)).alias("previous")
    )
    first, until = F.greatest(F.col("previous") - F.col("row") + 2, F.lit(low + 1)), F.least(F.col("number") - F.col("row"), F.lit(high))
    gaps = gaps.select("query_id", "row", first.alias("first"), until.alias("until")).where("first <= until")
    places = gaps.select("query_id", "row", F.explode(F.sequence("first", "until")).alias("place"))
    return places.select("query_id", (F.col("place") + F.col("row") - 1).alias("number"))


def select_distinct(match: Match, workspace: Workspace) -> DataFrame:
    """``(query_id, kept)`` for every query.

    With ``include_unmatched``, queries that positive scores leave short go on with documents of score 0.0. Those tie, so
    they come by id: documents are numbered by it once, and queries that are still short take the first ``depth`` of those
    that they do not match, then ten times as many each round. Negative scores come last.
    """
    options, documents = match.options, match.documents
    scores = workspace.save(match.scores, "scores")  # later rounds read them again
    selection = no_selection(match.queries.frame, scores, documents)

    def extend(selection, candidates):
        return extend_selection(selection, candidates, documents, options, workspace, match.queries.rows)

    if not options.include_unmatched:
        return extend(selection, scores)

    finished = []

    def unfinished(selection) -> tuple[DataFrame, int]:
        found = workspace.save_measured(
            selection.withColumn("short", F.size("kept") < options.k), "ranked", n_short=F.count_if("short")
        )
        finished.append(found.frame.where(~F.col("short")).drop("short"))
        return found.frame.where("short").drop("short"), found.observed["n_short"]

    short, n_short = unfinished(extend(selection, scores.where(F.col("score") > 0)))
    if n_short:
        scores = workspace.save(scores.join(short.select("query_id"), "query_id", "left_semi"), "scores")
        order = [F.asc("doc_id"), F.asc("doc_key")]
        numbers = workspace.save_measured(numbered(documents.select("doc_id", "doc_key"), order, "number", workspace), "numbers")
        scored = scores.where(F.col("score") != 0).select("query_id", "doc_key")
        taken = workspace.save(scored.join(numbers.frame, "doc_key").select("query_id", "number"), "taken")
        low, width = 0, options.depth
        while n_short and low < numbers.rows:
            high = min(numbers.rows, low + width)
            rows = unmatched(taken, short, numbers.rows, low, high).join(numbers.frame, "number")
            short, n_short = unfinished(extend(short, rows.select("query_id", "doc_key", "doc_id", F.lit(0.0).alias("score"))))
            low, width = high, width * 10
        if n_short:
            below = scores.where(F.col("score") < 0).join(short.select("query_id"), "query_id", "left_semi")
            finished.append(extend(short, below))
    return reduce(DataFrame.union, finished)


def rank_matches(match: Match, workspace: Workspace) -> DataFrame:
    kept = select_distinct(match, workspace)
    ranked = kept.select("query_id", F.posexplode("kept").alias("pos", "entry"))
    return ranked.join(match.queries.frame, "query_id").select(
        "query_id",
        "query",
        (F.col("pos") + 1).alias("rank"),
        F.col("entry.doc_id").alias("doc_id"),
        F.col("entry.score").alias("score"),
        F.col("entry.title").alias("title"),
    )


def rank_articles(
    articles: DataFrame, queries: DataFrame, options: RankOptions | None = None, workspace: Workspace | None = None
) -> DataFrame:
    """``(query_id, query, rank, doc_id, score, title)``: the best articles of every query.

    ``articles`` needs ``id``, ``title`` and ``contents``, ``queries`` needs ``query_id`` and ``query``.
    Work tables go to ``workspace``; the result reads from there, so keep it until the result is used.
    """
    options = options or RankOptions()
    workspace = workspace or Workspace(articles.sparkSession)
    return rank_matches(match_corpus(articles, queries, options, workspace), workspace)


def rank_files(
    spark: SparkSession,
    query_path: str,
    article_path: str,
    options: RankOptions | None = None,
    workspace: Workspace | None = None,
    rejects_path: str | None = None,
) -> DataFrame:
    """Rank the articles of a JSON-lines path for the queries of a text file.

    A line that is no article fails the job; with ``rejects_path`` such lines are written there instead, as JSON with the reason.
    """
    if rejects_path is None:
        articles = read_articles(spark, article_path, RANKED_FIELDS)
    else:
        articles, rejects = read_with_rejects(spark, article_path, RANKED_FIELDS)
        rejects.write.json(rejects_path)
    return rank_articles(articles, read_queries(spark, query_path), options, workspace)
