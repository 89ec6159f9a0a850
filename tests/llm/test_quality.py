import zlib

import pytest
from pyspark.sql.classic.dataframe import DataFrame

from quillrank import Workspace
from quillrank.llm.quality import accepted, scored, train, training_ids
from quillrank.llm.queries import LLM_QUERIES
from quillrank.sources.tables import read_table

FOLDER = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    rows = {r["doc_id"]: r for r in LLM_QUERIES["op4_quality_classifier"](spark, FOLDER).collect()}
    assert len(rows) == read_table(spark, FOLDER, "documents").count()
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in rows.items())
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in rows.values())
    right = [rows[r["doc_id"]]["predicted"] == r["quality"] for r in read_table(spark, FOLDER, "labels").collect() if rows[r["doc_id"]]["held_out"]]
    assert len(right) > 50 and sum(right) / len(right) > 0.95


DOCS = "doc_id long, text string, score string, quality int"
LABELS = "doc_id long, quality int, toxic int, text string"


def small(spark):
    docs = [(i, "clean words of a text " * 5 if i % 2 else "!!! ### !!! " * 9, "x", 7) for i in range(200)]
    docs += [(900, None, "", 0), (901, "", "", 0), (None, "clean words of a text", "", 0), (3, docs[3][1], "", 0), (902, "é" * 200000, "", 0)]
    labels = [(i, i % 2, 0, "x") for i in range(200)] + [(None, 1, 0, ""), (4, 1, 0, ""), (6, None, 0, ""), (950, 1, 0, "")]
    return spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS)


def test_edge_rows(spark):
    docs, labels = small(spark)
    with Workspace(spark) as workspace:
        model = train(docs, labels, workspace)
        again = train(docs, labels, workspace)
        rows = scored(docs, model).collect()
        kept = accepted(docs, model).collect()
    assert model.pack() == again.pack()
    assert len(rows) == 205 and all(0 <= r["score"] <= 1 for r in rows)
    by_id = {r["doc_id"]: r["score"] for r in rows}
    assert min(by_id[i] for i in range(1, 200, 2)) > 0.7 > 0.3 > max(by_id[i] for i in range(0, 200, 2))
    assert by_id[900] == by_id[901] and by_id[None] > 0.7
    assert {r["doc_id"] for r in kept} >= set(range(1, 200, 2)) | {None} and len(kept[0]) == 4


def test_training_ids(spark):
    _, labels = small(spark)
    rows = training_ids(labels, 10).collect()
    assert len(rows) == 20 and all(zlib.crc32(str(r["doc_id"]).encode()) % 5 for r in rows) and 4 not in {r["doc_id"] for r in rows}


@pytest.mark.parametrize("where", ["false", "quality = 1"])
def test_missing_labels(spark, where):
    docs, labels = small(spark)
    with Workspace(spark) as workspace:
        found = scored(docs, train(docs, labels.where(where), workspace, per_label=5)).collect()
        assert all(r["score"] == 0.5 if where == "false" else r["score"] >= 0.5 for r in found)
        assert scored(docs.limit(0), train(docs.limit(0), labels, workspace)).collect() == []


def test_driver_is_sent_one_model_a_round(spark, monkeypatch):
    sent, collect = [], DataFrame.collect

    def watched(frame):
        rows = collect(frame)
        sent.append(sum(len(x) for row in rows for x in row if isinstance(x, (bytes, bytearray))))
        return rows

    monkeypatch.setattr(DataFrame, "collect", watched)
    docs, labels = small(spark)
    with Workspace(spark) as workspace:
        model = train(docs, labels, workspace)
    assert 0 < max(sent) <= len(model.pack()) and sum(n > 0 for n in sent) == 8
