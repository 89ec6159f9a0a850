"""Query lists: one query per line."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def query_id(query: Column) -> Column:
    """A number made from the text alone: 60 bits of its MD5."""
    return F.conv(F.substring(F.md5(query.cast("binary")), 1, 15), 16, 10).cast("bigint")


def read_queries(spark: SparkSession, path: str) -> DataFrame:
    """``(query_id, query)``, a row per line. Ids are the same in whatever file and place a query stands."""
    return spark.read.text(path).select(query_id(F.col("value")).alias("query_id"), F.col("value").alias("query"))


def distinct_queries(queries: DataFrame) -> DataFrame:
    """One row per query text, under its lowest id."""
    return queries.groupBy("query").agg(F.min("query_id").alias("query_id")).select("query_id", "query")
