"""Articles to analyzed documents. All of it happens inside the row: no shuffle, no Python."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from quillrank.functions.text import tokenize
from quillrank.options import RankOptions


def is_paragraph(item: Column) -> Column:
    return F.coalesce(F.lower(item["subtype"]) == "paragraph", F.lit(False))


def first_paragraphs(contents: Column, count: int) -> Column:
    """The first ``count`` items that are paragraphs, in order. One without text takes a place too."""
    return F.slice(F.filter(contents, is_paragraph), 1, count)


def analyze_contents(articles: DataFrame, options: RankOptions) -> DataFrame:
    """Articles whose contents are the chosen paragraphs, each with its tokens."""
    paragraphs = first_paragraphs(F.col("contents"), options.max_paragraphs)
    return articles.withColumn(
        "contents",
        F.transform(
            paragraphs,
            lambda item: item.withField("tokens", tokenize(item["content"], options.rules, options.stopwords)),
        ),
    )


def analyze_documents(articles: DataFrame, options: RankOptions) -> DataFrame:
    """``(doc_id, title, title_tokens, body_tokens, doc_len)``, documents without any token included.

    The chosen paragraphs are joined before they are cut into tokens; the blank between them separates
    tokens as the end of a paragraph does.
    """
    paragraphs = first_paragraphs(F.col("contents"), options.max_paragraphs)
    body = F.array_join(F.transform(paragraphs, lambda item: item["content"]), " ")
    return articles.select(
        F.col("id").alias("doc_id"),
        "title",
        tokenize(F.col("title"), options.rules, options.stopwords).alias("title_tokens"),
        tokenize(body, options.rules, options.stopwords).alias("body_tokens"),
    ).withColumn("doc_len", F.size("title_tokens") + F.size("body_tokens"))


def non_empty(documents: DataFrame) -> DataFrame:
    return documents.where(F.col("doc_len") > 0)
