import random
import zlib

import pytest
from pyspark.sql import functions as F

from quillrank import Workspace
from quillrank.llm.queries import LLM_QUERIES
from quillrank.llm.sharding import document_order, hilbert_index, shard_boxes, sharded, write_shards
from quillrank.sources.tables import read_table


@pytest.mark.parametrize("n, bits", [(2, 3), (3, 2), (1, 4)])
def test_curve_visits_all_cells_in_steps_of_one(spark, n, bits):
    dims = [F.pmod(F.floor(F.col("id") / (1 << bits * i)), F.lit(1 << bits)) for i in range(n)]
    rows = spark.range(1 << bits * n).select(hilbert_index(dims, bits).alias("h"), *[d.alias(f"d{i}") for i, d in enumerate(dims)]).collect()
    cells = {r[0]: r[1:] for r in rows}
    assert sorted(cells) == list(range(1 << bits * n))
    assert all(sum(abs(a - b) for a, b in zip(cells[i], cells[i + 1])) == 1 for i in range(len(cells) - 1))


def place(spark, docs, shards=24):
    frame = spark.createDataFrame(docs, "doc_id long, text string, source string, lang string, rank int, n int")
    keyed = frame.select("*", *document_order()[:-1])
    with Workspace(spark) as workspace:
        return sharded(keyed, [F.col(c) for c in ("hilbert", "text_crc32", "text_bytes", "doc_id")], workspace, shards).collect()


def test_runs(spark):
    rng = random.Random(1)
    docs = [(rng.choice([None, i]), rng.choice([None, "", "same", "é" * rng.randrange(2000)]), rng.choice([None, "a", "b"]), rng.choice([None, "x"]), 1, 1) for i in range(500)]
    docs += [docs[0]] * 300
    rows = place(spark, docs)
    assert sorted(map(repr, docs)) == sorted(repr(tuple(r)[:6]) for r in rows)
    slots = {}
    for r in rows:
        slots.setdefault(r["shard"], []).append(r["slot"])
        assert r["text_crc32"] == zlib.crc32((r["text"] or "").encode()) and r["text_bytes"] == len((r["text"] or "").encode())
    assert sorted(slots) == list(range(24)) and {len(s) for s in slots.values()} == {33, 34}
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    inner = sorted(rows, key=lambda r: (r["shard"], r["slot"]))
    order = [(r["hilbert"], r["text_crc32"], r["text_bytes"]) for r in inner]
    assert order == sorted(order)


def test_few_rows(spark):
    assert place(spark, []) == []
    assert sorted((r["shard"], r["slot"]) for r in place(spark, [(1, "a", None, None, 1, 1)] * 3, 5)) == [(0, 0), (1, 0), (3, 0)]


def test_shards_prune(spark, tmp_path):
    docs = [(i, "x" * (i % 50), f"s{i % 4}", "en", 1, 1) for i in range(400)]
    frame = spark.createDataFrame(docs, "doc_id long, text string, source string, lang string, rank int, n int").select("*", *document_order()[:-1])
    with Workspace(spark) as workspace:
        placed = sharded(frame, [F.col("hilbert"), F.col("doc_id")], workspace, 8)
        write_shards(placed, str(tmp_path / "out"))
        boxes = shard_boxes(placed, ["source", "text_bytes"]).collect()
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == 400 and sum(b["rows"] for b in boxes) == 400
    assert sum(b["min_source"] <= "s1" <= b["max_source"] for b in boxes) < 8


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    texts = dict(read_table(spark, folder, "documents").select("doc_id", "text").collect())
    rows = LLM_QUERIES["op10_hilbert_sharding"](spark, folder).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(texts)
    counts = [sum(r["shard"] == s for r in rows) for s in range(24)]
    assert max(counts) - min(counts) <= 1 and {r["law"] for r in rows} == {"rows"} and {r["grown_shard"] for r in rows} == {None}
    assert all(r["size"] == len(texts[r["doc_id"]].encode()) + 8 and r["text_crc32"] == zlib.crc32(texts[r["doc_id"]].encode()) for r in rows)
