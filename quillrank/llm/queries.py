"""Each operator over its whole table, as a query with a fixed result; the pipeline's operators included."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from quillrank.llm.alignment import aligned
from quillrank.llm.decontamination import find_items, n_hit
from quillrank.llm.line_dedup import LONG_WORDS, n_removed, without_repeats
from quillrank.llm.mixing import count_words, place, taken_words
from quillrank.llm.neighbours import nearest
from quillrank.llm.ngram_join import near_duplicates
from quillrank.llm.ppm import scored as model_scores
from quillrank.llm.prefix_trie import prefix_trie
from quillrank.llm.quality import THRESHOLD, remainder, scored, train
from quillrank.llm.secrets import count_kind, listed, log_ratios, scan, with_base_spans
from quillrank.llm.sharding import document_order, sharded
from quillrank.llm.substring_dedup import repeats
from quillrank.llm.warc import read_records, write_archives
from quillrank.sources.tables import read_table
from registry.session import session_workspace

LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(function: Callable[[SparkSession, str], DataFrame]):
    LLM_QUERIES[function.__name__] = function
    return function


@query
def op8_benchmark_decontamination(spark, folder):
    found = find_items(read_table(spark, folder, "documents"), read_table(spark, folder, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        n_hit().alias("n_hit"),
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
        "longest",
    )


@query
def op10_hilbert_sharding(spark, folder):
    documents = read_table(spark, folder, "documents")
    light = documents.select(*document_order())
    placed = sharded(light, [F.col(name) for name in light.columns], session_workspace(spark))
    return placed.select(
        "doc_id",
        (F.col("text_bytes") + 8).alias("size"),
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "hilbert",
    )


@query
def op9_source_mixing(spark, folder):
    workspace = session_workspace(spark)
    documents = read_table(spark, folder, "documents").select("doc_id", "source", count_words(F.col("text")).alias("size"))
    placed = place(workspace.save(documents, "sizes"), workspace)
    return taken_words(placed).select("doc_id", "size", "source_size", "target", "taken")


@query
def op4_quality_classifier(spark, folder):
    documents = read_table(spark, folder, "documents")
    model = train(documents, read_table(spark, folder, "labels"), session_workspace(spark))
    return scored(documents, model).select(
        "doc_id",
        F.coalesce(remainder(F.col("doc_id")) == 0, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


@query
def op3_secret_scans(spark, folder):
    found = with_base_spans(read_table(spark, folder, "documents"))
    # Every document has its spans written, so the texts are searched once.
    found = session_workspace(spark).save(found, "spans")
    scanned = scan(found, log_ratios(found))
    base = F.col("base")
    return scanned.select(
        "doc_id",
        *[count_kind(base, kind).alias(f"n_{kind}") for kind in ("assign", "access", "hex")],
        F.sha2(listed(base), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"),
    )


@query
def op5_warc(spark, folder):
    workspace = session_workspace(spark)
    index = write_archives(read_table(spark, folder, "pages"), workspace.folder("warc"), workspace)
    records = read_records(index, payloads=False)
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query
def op6_nearest_neighbours(spark, folder):
    return nearest(read_table(spark, folder, "embeddings"), F.col("vec_id") % 50 == 0)


@query
def op1_ngram_jaccard_join(spark, folder):
    return near_duplicates(read_table(spark, folder, "documents"), session_workspace(spark))


@query
def op7_substring_dedup(spark, folder):
    return repeats(read_table(spark, folder, "documents"), session_workspace(spark))


def _deduplicated_lines(spark, folder, long_words):
    kept = without_repeats(read_table(spark, folder, "documents"), session_workspace(spark), long_words=long_words)
    return kept.select(
        "doc_id",
        "n_lines",
        n_removed().alias("n_removed"),
        F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"),
    )


@query
def op2_line_dedup(spark, folder):
    return _deduplicated_lines(spark, folder, None)  # its SQL counts lines alone


@query
def op2_line_dedup_long_lines(spark, folder):
    return _deduplicated_lines(spark, folder, LONG_WORDS)


@query
def op13_tokenizer_alignment(spark, folder):
    return aligned(read_table(spark, folder, "documents"), session_workspace(spark))


@query
def op12_conversation_prefix_trie(spark, folder):
    return prefix_trie(read_table(spark, folder, "conversations"), session_workspace(spark))


@query
def op11_ppm_scoring(spark, folder):
    return model_scores(read_table(spark, folder, "documents"), session_workspace(spark))
