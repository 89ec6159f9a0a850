import random

import pytest
from pyspark.sql import functions as F

from quillrank import Workspace
from quillrank.llm import mixing
from quillrank.llm.mixing import count_words, mixed_texts, place, shuffled, slots, source_targets, taken_words
from quillrank.llm.queries import LLM_QUERIES
from tests.llm import plain

SCHEMA = "doc_id long, text string, source string, copy int, length int, words int"


@pytest.mark.parametrize("size", [1, 2, 7, 64, 1000])
def test_permutation(spark, size):
    n, seed = F.lit(size).cast("long"), F.lit(5)
    rows = spark.range(size).select("id", shuffled(F.col("id"), n, seed).alias("p")).select("id", "p", shuffled(F.col("p"), n, seed, True).alias("q")).collect()
    assert sorted(r["p"] for r in rows) == list(range(size)) and all(r["id"] == r["q"] for r in rows)
    assert size < 64 or sum(r["id"] == r["p"] for r in rows) < size / 10


def test_targets(spark):
    rng = random.Random(6)
    for sizes in ({"a": 5}, {"a": 0, "b": 0}, {None: 3, "é": 900, "z": 1, "B": 40}, {f"s{i}": rng.choice([0, 1, 10, 5000]) for i in range(12)}):
        frame = spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, size long")
        got = {r["source"]: r["target"] for r in source_targets(frame).collect()}
        assert got == pytest.approx(plain.targets(sizes))


def corpus():
    rng = random.Random(8)
    docs = []
    for i in range(300):
        source = rng.choice(["a", "a", "a", "a", "b", "c", None, "d"])
        n = rng.choice([0, 1, 5, 40, 130, 700]) if source != "d" else rng.choice([0, 1])
        docs.append((i if i % 50 else None, rng.choice([" ", " \n"]).join(f"w{i}.{k}" for k in range(n)), source))
    return docs + [(900, None, "a"), (901, " ", "b"), (902, "x " * 9000, "c"), docs[7], docs[7]]


def test_mix(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 20)
    monkeypatch.setattr(mixing, "CHUNK", 7)
    docs = corpus()
    frame = spark.createDataFrame([(*d, 1, 1, 1) for d in docs], SCHEMA).select("doc_id", "text", "source", count_words(F.col("text")).alias("size"))
    with Workspace(spark) as workspace:
        placed = place(frame, workspace)
        rows = taken_words(placed).collect()
        again = taken_words(place(frame, workspace)).collect()
        mix = mixed_texts(placed).collect()
        places = slots(placed.sources).select("place").collect()
    key = lambda r: repr((r["doc_id"], r["text"], r["source"], r["taken"]))
    assert sorted(map(key, rows)) == sorted(map(key, again)) and len(rows) == len(docs)
    assert sorted(r["place"] for r in places) == list(range(len(places)))
    sizes = {}
    for r in rows:
        assert r["size"] == len(plain.words(r["text"])) and 0 <= r["taken"] <= 2 * r["size"]
        sizes[r["source"]] = sizes.get(r["source"], 0) + r["size"]
    for source, target in plain.targets(sizes).items():
        own = [r for r in rows if r["source"] == source]
        assert {r["source_size"] for r in own} == {sizes[source]} and own[0]["target"] == pytest.approx(target)
        assert abs(sum(r["taken"] for r in own) - target) <= max(mixing.BLOCK_WORDS, 0.02 * target)
    # The texts of the mix are what is counted, and come from their documents.
    assert sum(len(plain.words(r["text"])) for r in mix) == sum(r["taken"] for r in rows)
    by_id = {r["doc_id"]: r["text"] for r in rows if r["doc_id"] is not None}
    for r in mix:
        if r["doc_id"] is not None:
            whole = set(plain.words(by_id[r["doc_id"]]))
            assert set(plain.words(r["text"])) <= whole


def test_empty(spark):
    frame = spark.createDataFrame([], "doc_id long, source string, size long")
    nothing = spark.createDataFrame([(1, "a", 0), (2, None, 0)], "doc_id long, source string, size long")
    with Workspace(spark) as workspace:
        assert taken_words(place(frame, workspace)).collect() == []
        assert [r["taken"] for r in taken_words(place(nothing, workspace)).collect()] == [0, 0]


def test_query(spark):
    rows = LLM_QUERIES["op9_source_mixing"](spark, "/root/testdata/sf0.001").collect()
    assert all(r["taken"] <= 2 * r["size"] for r in rows)
    total = {r["source_size"]: 0 for r in rows}
    for r in rows:
        total[r["source_size"]] += r["taken"]
    assert sum(total.values()) == pytest.approx(1.5 * sum(r["size"] for r in rows), rel=0.02)
