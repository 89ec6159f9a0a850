"""From documents to shards of training data: five operators in turn, each over all that the one before has kept.

Every stage takes nulls in any column, empty and very long texts (never cut), ties, repeated rows, empty tables (which stay
empty) and further columns of any name, which it drops. Its docstring says what becomes of such rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from quillrank.llm.decontamination import decontaminated, find_items
from quillrank.llm.mixing import count_words, mixed_texts, place
from quillrank.llm.ngram_join import near_duplicates, representatives
from quillrank.llm.quality import accepted, train
from quillrank.llm.sharding import document_order, sharded
from quillrank.sources.tables import read_table
from registry.session import session_workspace

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts. A null text is scored as an empty one; every repeated row is scored alike, and a row
    without an id like any other."""
    docs = docs.select(*COLUMNS)
    return accepted(docs, train(docs, read_table(spark, sf_dir, "labels"), session_workspace(spark)))


def near_duplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, the one with the smallest id. Null and empty texts are like nothing and stay; of
    equal rows one stays, of several texts under the smallest id each; rows without an id stay."""
    docs = docs.select(*COLUMNS)
    return representatives(docs, near_duplicates(docs, session_workspace(spark))).select(*COLUMNS)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item. Null and empty texts hold none and stay, as do repeated rows, each judged
    for itself; items without words have no window; without items all stay."""
    found = find_items(docs, read_table(spark, sf_dir, "benchmark"), keep=COLUMNS)
    return decontaminated(found, max_coverage=0.0)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of sources: of each document what its blocks contribute, once per time that they are taken. A null source is one of its
    own, the last; null and empty texts have no words, so nothing of them is taken; repeated rows each have their share."""
    docs = docs.select(*COLUMNS, count_words(F.col("text")).alias("size"))
    mixed = mixed_texts(place(docs, session_workspace(spark)))
    return mixed.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*COLUMNS)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with their shard and their place in it. Nulls are keys like others, the smallest; ties and repeated rows get
    places next to each other, each its own."""
    docs = docs.select(*COLUMNS)
    keyed = docs.select("*", *document_order()[:-1])
    return sharded(keyed, [F.col(name) for name in ("hilbert", "text_crc32", "text_bytes", "doc_id")], session_workspace(spark))


STAGES = [
    ("quality_classifier", quality),
    ("ngram_jaccard_join", near_duplicate),
    ("benchmark_decontamination", decontaminate),
    ("source_mixing", mix),
    ("hilbert_sharding", shard),
]

ORACLE_SQL = None  # the classifier is trained; tests compare each stage with a plain version


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, workspace = read_table(spark, sf_dir, "documents"), session_workspace(spark)
    for name, stage in STAGES:
        docs = workspace.save(stage(spark, docs, sf_dir), name)
    return docs
