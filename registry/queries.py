"""Every operator as a query over the sample tables. Names and column names agree with ``registry.oracle``."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession, functions as F

from quillrank.functions.porter import stem
from quillrank.functions.text import TokenRules, remove_stopwords, tokenize
from quillrank.functions.titles import title_distance
from quillrank.operators.diversity import near_duplicate_titles, with_titles
from quillrank.operators.documents import analyze_contents, analyze_documents, first_paragraphs, non_empty
from quillrank.operators.matching import collection_tf, corpus_stats
from quillrank.operators.ranking import rank_all, top_per_query
from quillrank.operators.stopwords import read_words, without_words
from quillrank.operators.terms import kept_stem_vocabulary, query_terms, stem_vocabulary, vocabulary
from quillrank.options import RankOptions
from quillrank.plans.ranking import Match, match_corpus, rank_matches, select_distinct
from quillrank.sinks.packed import read_packed_report, write_packed_report
from quillrank.sinks.report import file_name, nested, read_report, report_lines, write_report
from quillrank.sources.articles import ARTICLE, decode_articles, read_articles, read_with_rejects
from quillrank.sources.queries import distinct_queries, read_queries
from quillrank.sources.tables import read_table, sample_articles, sample_queries
from quillrank.workspace import Workspace
from registry.session import session_workspace

# Two engines that add in different order agree on so many digits; scores are shown with six.
PLAIN = RankOptions(stem=False, score_digits=10)
SHOWN = 6
STEMMED = replace(PLAIN, stem=True)
LIMITS = TokenRules(max_length=20, max_digits=4, max_repeats=3)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(name: str):
    def register(function):
        QUERIES[name] = function
        return function

    return register


def match(spark: SparkSession, sf: str, options: RankOptions = PLAIN) -> tuple[Match, Workspace]:
    workspace = session_workspace(spark)
    return match_corpus(sample_articles(spark, sf), sample_queries(spark, sf), options, workspace), workspace


def shown(frame: DataFrame) -> DataFrame:
    return frame.withColumn("score", F.round("score", SHOWN))


def ranked(spark: SparkSession, sf: str, options: RankOptions = PLAIN) -> DataFrame:
    return shown(rank_matches(*match(spark, sf, options)))


def texts(spark: SparkSession, sf: str) -> DataFrame:
    return read_table(spark, sf, "documents").select("doc_id", "text")


def joined(tokens) -> F.Column:
    return F.array_join(tokens, " ")


# Sources


@query("queries_scan")
def _queries_scan(spark, sf):
    path = session_workspace(spark).folder("queries")
    sample_queries(spark, sf).select("query").write.text(path)
    return distinct_queries(read_queries(spark, path))


def _flat_article(article: DataFrame) -> DataFrame:
    return article.select(
        F.col("id").cast("bigint").alias("doc_id"),
        "article_url",
        "title",
        "author",
        "published_date",
        F.size("contents").alias("n_contents"),
        F.array_join(F.transform("contents", lambda c: c["content"]), "\n").alias("body"),
        F.array_join(F.transform("contents", lambda c: F.coalesce(c["subtype"], F.lit("-"))), " ").alias("subtypes"),
        "source",
    )


@query("articles_scan")
def _articles_scan(spark, sf):
    path = session_workspace(spark).folder("articles")
    sample_articles(spark, sf, ARTICLE).write.json(path)
    return _flat_article(read_articles(spark, path))


@query("json_decode")
def _json_decode(spark, sf):
    lines = sample_articles(spark, sf, ARTICLE).select(F.to_json(F.struct("*")).alias("value"))
    return _flat_article(lines.select(decode_articles(F.col("value")).alias("article")).select("article.*"))


@query("article_rejects")
def _article_rejects(spark, sf):
    path = session_workspace(spark).folder("mixed")
    articles = sample_articles(spark, sf, ARTICLE).select(F.to_json(F.struct("*")).alias("value"))
    broken = texts(spark, sf).select(F.explode(F.split("text", "\n")).alias("value"))
    wrong = [f'"{field}":{value}' for field, value in (("title", '{"a":1}'), ("published_date", '"soon"'), ("contents", '[{"content":[]}]'))]
    kinds = F.array(*[F.concat(F.lit('{"id":"'), F.col("doc_id"), F.lit(f'",{w}}}')) for w in wrong])
    articles.union(broken).union(texts(spark, sf).select(F.explode(kinds))).write.text(path)
    return read_with_rejects(spark, path)[1]


# Text analysis


@query("tokenize")
def _tokenize_text(spark, sf):
    tokens = texts(spark, sf).select("doc_id", tokenize(F.col("text")).alias("tokens"))
    return tokens.select("doc_id", F.size("tokens").alias("n_tokens"), joined("tokens").alias("tokens"))


@query("tokenize_limits")
def _tokenize_limits(spark, sf):
    tokens = texts(spark, sf).select("doc_id", tokenize(F.col("text"), LIMITS).alias("tokens"))
    return tokens.select("doc_id", F.size("tokens").alias("n_tokens"), joined("tokens").alias("tokens"))


@query("stopword_filter")
def _stopword_filter(spark, sf):
    tokens = texts(spark, sf).select("doc_id", tokenize(F.col("text")).alias("tokens"))
    kept = tokens.select("doc_id", remove_stopwords(F.col("tokens"), PLAIN.stopwords).alias("tokens"))
    return kept.select("doc_id", F.size("tokens").alias("n_tokens"), joined("tokens").alias("tokens"))


@query("stopword_filter_table")
def _stopword_filter_table(spark, sf):
    """The words as a text file, and as many again that no text has."""
    workspace = session_workspace(spark)
    path = workspace.folder("words")
    words = spark.createDataFrame([(word,) for word in PLAIN.stopwords], "value string")
    words.union(texts(spark, sf).select(F.concat(F.lit("-"), "doc_id").alias("value"))).write.text(path)
    tokens = texts(spark, sf).select("doc_id", tokenize(F.col("text")).alias("tokens"))
    rows = workspace.save(tokens.withColumn("row", F.monotonically_increasing_id()), "tokens")
    kept = without_words(rows, "row", ["tokens"], read_words(spark, path), PLAIN, workspace)
    return kept.select("doc_id", F.size("tokens").alias("n_tokens"), joined("tokens").alias("tokens"))


@query("query_terms")
def _query_terms(spark, sf):
    return query_terms(sample_queries(spark, sf), PLAIN)


@query("analyzed_terms")
def _analyzed_terms(spark, sf):
    return analyze_documents(sample_articles(spark, sf), PLAIN).select(
        "doc_id", joined("title_tokens").alias("title_terms"), joined("body_tokens").alias("body_terms")
    )


@query("query_terms_stemmed")
def _query_terms_stemmed(spark, sf):
    return query_terms(sample_queries(spark, sf), STEMMED)


@query("analyzed_terms_stemmed")
def _analyzed_terms_stemmed(spark, sf):
    stems = lambda tokens: joined(F.transform(tokens, stem))
    return analyze_documents(sample_articles(spark, sf), PLAIN).select(
        "doc_id", stems("title_tokens").alias("title_terms"), stems("body_tokens").alias("body_terms")
    )


@query("first_paragraphs")
def _first_five_paragraphs(spark, sf):
    chosen = first_paragraphs(F.col("contents"), PLAIN.max_paragraphs)
    return (
        sample_articles(spark, sf)
        .select(F.col("id").alias("doc_id"), F.posexplode(chosen).alias("pos", "item"))
        .select("doc_id", "pos", "item.subtype", "item.content")
    )


@query("analyzed_contents")
def _analyzed_contents(spark, sf):
    return (
        analyze_contents(sample_articles(spark, sf), PLAIN)
        .select(F.col("id").alias("doc_id"), F.posexplode("contents").alias("pos", "item"))
        .select("doc_id", "pos", "item.content", joined("item.tokens").alias("tokens"))
    )


@query("doc_length")
def _doc_length(spark, sf):
    return analyze_documents(sample_articles(spark, sf), PLAIN).select("doc_id", "doc_len")


@query("non_empty_docs")
def _non_empty_docs(spark, sf):
    return non_empty(analyze_documents(sample_articles(spark, sf), PLAIN)).select("doc_id", "title", "doc_len")


@query("stem_vocabulary")
def _stem_vocabulary(spark, sf):
    return stem_vocabulary(vocabulary(analyze_documents(sample_articles(spark, sf), STEMMED)), STEMMED)


@query("stem_vocabulary_kept")
def _stem_vocabulary_kept(spark, sf):
    """The table has the words of the queries from a run before, and gets the others of the corpus."""
    workspace = session_workspace(spark)
    path = workspace.folder("stem-table")
    asked = query_terms(sample_queries(spark, sf), PLAIN).select(F.col("term").alias("token")).distinct()
    kept_stem_vocabulary(asked, path, STEMMED, workspace)
    return kept_stem_vocabulary(vocabulary(analyze_documents(sample_articles(spark, sf), STEMMED)), path, STEMMED, workspace)


# Corpus statistics and matches


@query("corpus_stats")
def _corpus_statistics(spark, sf):
    return corpus_stats(analyze_documents(sample_articles(spark, sf), PLAIN)).withColumn(
        "avg_len", F.round("avg_len", 6)
    )


@query("term_frequencies")
def _term_frequencies(spark, sf):
    return match(spark, sf)[0].postings.select("doc_id", "doc_len", "term", "tf")


@query("collection_tf")
def _collection_term_frequencies(spark, sf):
    return collection_tf(match(spark, sf)[0].hits)


@query("doc_query_pairs")
def _doc_query_pairs(spark, sf):
    return (
        match(spark, sf)[0]
        .term_scores.groupBy("query_id", "doc_key", "doc_id", "doc_len")
        .agg(F.count(F.lit(1)).alias("n_matched"), F.sum("tf").alias("total_tf"))
        .select("query_id", "doc_id", "doc_len", "n_matched", "total_tf")
    )


# Scores


@query("dph_term_scores")
def _dph_term_scores(spark, sf):
    return match(spark, sf)[0].term_scores.select(
        "query_id", "doc_id", "term", "tf", "cf", F.round("term_score", 6).alias("term_score")
    )


@query("dph_scores")
def _dph_scores(spark, sf):
    return shown(match(spark, sf)[0].scores.select("query_id", "doc_id", "score"))


@query("dph_scores_integer_ratio")
def _dph_scores_integer_ratio(spark, sf):
    return shown(match(spark, sf, replace(PLAIN, ratio="integer"))[0].scores.select("query_id", "doc_id", "score"))


# Rankings


@query("ranked_all")
def _ranked_all(spark, sf):
    found, workspace = match(spark, sf)
    ranking = rank_all(workspace.save(found.scores, "scores"), PLAIN, workspace)
    return shown(ranking.select("query_id", "doc_id", "score", F.col("position").cast("int")))


def _top10(spark, sf):
    found, _ = match(spark, sf)
    return shown(with_titles(top_per_query(found.scores, PLAIN.k), found.documents, found.queries.rows * PLAIN.k, PLAIN))


@query("top10_raw")
def _top10_raw(spark, sf):
    return _top10(spark, sf).select("query_id", "position", "doc_id", "score", "title")


@query("title_distances")
def _title_distances(spark, sf):
    """The title of a document against each of its content items; null where there is no title."""
    items = sample_articles(spark, sf).select(F.col("id").alias("doc_id"), "title", F.posexplode("contents").alias("pos", "item"))
    plain = F.regexp_replace("item.content", "[^ -~]", "?")
    return items.select("doc_id", "pos", F.round(title_distance(F.col("title"), plain), 6).alias("distance"))


@query("title_pairs")
def _title_pairs(spark, sf):
    return near_duplicate_titles(_top10(spark, sf), PLAIN)


@query("dedup_titles")
def _dedup_titles(spark, sf):
    kept = select_distinct(*match(spark, sf))
    return kept.select("query_id", F.posexplode("kept").alias("pos", "entry")).select(
        "query_id", "pos", "entry.doc_id", "entry.title"
    )


@query("ranked_top10")
def _ranked_top10(spark, sf):
    return ranked(spark, sf)


@query("ranked_top10_integer_ratio")
def _ranked_top10_integer_ratio(spark, sf):
    return ranked(spark, sf, replace(PLAIN, ratio="integer"))


@query("ranked_include_unmatched")
def _ranked_include_unmatched(spark, sf):
    return ranked(spark, sf, replace(PLAIN, include_unmatched=True))


@query("ranked_include_unmatched_integer_ratio")
def _ranked_include_unmatched_integer_ratio(spark, sf):
    return ranked(spark, sf, replace(PLAIN, include_unmatched=True, ratio="integer"))


@query("ranked_without_stopword_list")
def _ranked_without_stopword_list(spark, sf):
    return ranked(spark, sf, replace(PLAIN, stopwords=(), include_unmatched=True, ratio="integer"))


@query("ranked_top10_stemmed")
def _ranked_top10_stemmed(spark, sf):
    return ranked(spark, sf, STEMMED)


@query("ranked_top10_body_passes2")
def _ranked_top10_body_passes2(spark, sf):
    return ranked(spark, sf, replace(STEMMED, body_passes=2))


# Output


@query("ranking_nested")
def _ranking_nested(spark, sf):
    rows = nested(ranked(spark, sf))
    return rows.select(
        "query_id",
        F.size("results").alias("n_results"),
        F.array_join(F.transform("results", lambda r: F.concat(r["rank"], F.lit(":"), r["doc_id"])), " ").alias("results"),
    )


@query("ranking_report")
def _ranking_report(spark, sf):
    return report_lines(ranked(spark, sf)).select("query_id", "line_no", "line")


@query("report_files")
def _report_files(spark, sf):
    path = session_workspace(spark).folder("report")
    write_report(ranked(spark, sf), path)
    return read_report(spark, path).withColumn("query_id", F.col("query_id").cast("bigint"))


@query("report_packed")
def _report_packed(spark, sf):
    workspace = session_workspace(spark)
    path = workspace.folder("packed")
    write_packed_report(ranked(spark, sf), path, workspace)
    return read_packed_report(spark, path)


@query("ranking_file_name")
def _ranking_file_name(spark, sf):
    return sample_queries(spark, sf).select("query_id", file_name(F.col("query")).alias("file_name"))
