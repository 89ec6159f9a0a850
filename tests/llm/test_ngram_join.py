import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quillrank import Workspace
from quillrank.llm.components import components
from quillrank.llm import ngram_join
from quillrank.llm.ngram_join import near_duplicates, representatives
from tests.llm import plain

SCHEMA = "doc_id long, text string, name string, n int, gram string"


def run(spark, docs, **how):
    frame = spark.createDataFrame([(*d, "x", 1, None) for d in docs], SCHEMA)
    with Workspace(spark) as workspace:
        return sorted([tuple(r) for r in near_duplicates(frame, workspace, **how).collect()], key=repr)


def corpus(seed):
    rng = random.Random(seed)
    base = [[rng.choice("abcdefghijklmnopqrst") + rng.choice("xyzuvw") for _ in range(rng.choice([30, 80, 120]))] for _ in range(5)]
    docs = []
    for i in range(90):
        found = list(rng.choice(base))
        for _ in range(rng.choice([0, 0, 1, 1, 2, 3, 6])):
            found[rng.randrange(len(found))] = rng.choice(["new", "NEW", f"w{i}"])
        docs.append((i * 3 % 91, rng.choice([" ", "\n", " \t"]).join(found)))
    docs += [(200, None), (201, ""), (202, " \n"), (203, "a b"), (204, "A  b"), (205, "a b c"), (206, "q " * 5000), (207, "q " * 6000)]
    docs += [(None, docs[0][1]), (None, "a b"), docs[3], docs[3], (docs[4][0], "another text under one id, in five words")]
    return docs


@pytest.mark.parametrize("seed, frequent", [(1, 1e-5), (2, 0.002), (3, 0.05)])
def test_like_brute_force(spark, seed, frequent):
    docs = corpus(seed)
    got = run(spark, docs, frequent=frequent)
    assert got == plain.near_duplicates(docs)
    assert len({r[2] for r in got}) < len(got) - 20


def test_chain(spark):
    """Neighbours link, ends do not; all are one component."""
    text = [f"w{i}" for i in range(60)]
    docs = [(10 - k, " ".join(text[2 * k : 2 * k + 40])) for k in range(8)]
    assert run(spark, docs) == plain.near_duplicates(docs) and {r[2] for r in run(spark, docs)} == {3}


def test_empty(spark):
    assert run(spark, []) == [] and run(spark, [(1, None)]) == [(1, 0, 1)]


def test_representatives(spark):
    docs = [(2, "a b c d e f"), (1, "a b c d e f"), (1, "a b c d e f"), (3, "other words are in this one"), (None, "a b c d e f"), (4, None)]
    frame = spark.createDataFrame([(*d, "x", 1, None) for d in docs], SCHEMA)
    with Workspace(spark) as workspace:
        rows = representatives(frame, near_duplicates(frame, workspace)).collect()
    assert sorted([r["doc_id"] for r in rows], key=repr) == [1, 3, 4, None]


def test_components(spark):
    rng = random.Random(4)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(180)] + [(i, i + 1) for i in range(500, 540)] + [(900, x) for x in range(901, 960)]
    root = {x: x for link in links for x in link}
    for _ in range(400):
        for a, b in links:
            root[a] = root[b] = min(root[a], root[b])
    with Workspace(spark) as workspace:
        got = {r["node"]: r["component"] for r in components(spark.createDataFrame(links, "a long, b long"), workspace).collect()}
        none = components(spark.createDataFrame([], "a long, b long"), workspace).collect()
    assert got == {x: root[x] for link in links if link[0] != link[1] for x in link} and none == []


@pytest.mark.parametrize("size", [100, 400])
def test_candidates_of_a_group_are_linear(spark, monkeypatch, size):
    """Loose variants of one text: each is alike to few or none of the others, and is not compared with all."""
    rng = random.Random(size)
    base = [f"w{i}" for i in range(120)]
    docs = []
    for i in range(size):
        found = list(base)
        for j in rng.sample(range(120), 12):
            found[j] = f"u{i}x{j}"
        docs.append((i, " ".join(found)))
    rows, compared = [], ngram_join._compared
    monkeypatch.setattr(ngram_join, "_compared", lambda *a: rows.append(compared(*a)) or rows[-1])
    got = []
    with Workspace(spark) as workspace:
        frame = spark.createDataFrame([(*d, "x", 1, None) for d in docs], SCHEMA)
        got = sorted([tuple(r) for r in near_duplicates(frame, workspace).collect()], key=repr)
        n = sum(r.count() for r in rows)
    assert n <= 4 * size
    if size == 100:
        assert got == plain.near_duplicates(docs)


def test_lists_are_shuffled_once(spark, monkeypatch):
    """Rows are made distinct where the shuffle by n-gram has put them."""
    plans, save = {}, Workspace.save
    monkeypatch.setattr(Workspace, "save", lambda self, frame, name, by=None: plans.setdefault(name, frame) and save(self, frame, name, by))
    words = "a b c d e f g h i j k l m n o p q r s t u v w x y z".split()
    docs = spark.createDataFrame([(i, " ".join(words[: 20 + i % 5])) for i in range(20)], "doc_id long, text string")
    with Workspace(spark) as workspace:
        near_duplicates(docs, workspace).collect()
        assert plans["lists"]._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1


@pytest.mark.parametrize("work", ["describe", "prefixes", "segments"])
def test_task_in_little_memory(monkeypatch, work):
    """What a task holds beside its input does not grow with the batches that it is sent, here of 6 MB of text."""
    monkeypatch.setattr(ngram_join, "maybe", lambda wanted, names: np.ones(len(names), bool))
    order = ngram_join.Order(np.zeros(0, np.uint64), np.zeros(0, np.int64))
    run = {"describe": ngram_join._describe(1e-5), "prefixes": ngram_join._prefixes(order), "segments": ngram_join._segments(order, None)}[work]
    words = [f"w{x:05}" for x in np.random.default_rng(5).integers(0, 100000, 900000).tolist()]
    texts = [" ".join(words[i : i + 300]) for i in range(0, len(words), 300)]
    batch = pa.record_batch({"doc_id": pa.array(range(len(texts)), pa.int64()), "text": pa.array(texts)})
    tracemalloc.start()
    for _ in run(iter([batch] * 3)):
        pass
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 100e6, peak


def test_sketches_bound_the_difference(spark):
    """Sets of all sizes, empty ones and pairs whose sketches have not the same length."""
    rng = np.random.default_rng(6)
    sets = [np.unique(rng.integers(0, 1 << 63, size).astype(np.uint64)) for size in (1, 3, 64, 65, 70, 130, 500, 520, 3000)]
    sets += [np.unique(np.concatenate([x[: len(x) * 9 // 10], rng.integers(0, 1 << 63, len(x) // 10).astype(np.uint64)])) for x in sets]
    sets = [np.zeros(0, np.uint64), *sets]
    sketches = ngram_join.sketches_of(np.concatenate(sets), np.cumsum([0, *map(len, sets)])).to_pylist()
    assert [len(x) for x in sketches[:9]] == [0, 1, 1, 1, 2, 2, 4, 8, 16]
    rows = [(i, j, sketches[i], sketches[j]) for i in range(len(sets)) for j in range(len(sets)) if 0.5 <= (len(sketches[i]) or 9) / (len(sketches[j]) or 9) <= 2]
    frame = spark.createDataFrame(rows, "i int, j int, a array<long>, b array<long>")
    found = {(r["i"], r["j"]): r["n"] for r in frame.select("i", "j", ngram_join._differing(F.col("a"), F.col("b")).alias("n")).collect()}
    assert all(n <= len(np.setxor1d(sets[i], sets[j])) for (i, j), n in found.items())
    assert found[7, 8] > 150 and found[7, 16] > 40 and found[7, 7] == 0 and any(len(sketches[i]) != len(sketches[j]) for i, j in found)


def test_unlike_pairs_are_not_compared(spark, monkeypatch):
    """Half of two texts is the same, and in an order by chance that comes first in many of them."""
    monkeypatch.setattr(ngram_join, "levels_of", lambda described: np.zeros(ngram_join.SLOTS, np.uint8))
    rows, overlaps = [], ngram_join.overlaps
    monkeypatch.setattr(ngram_join, "overlaps", lambda *a: rows.append(a[1].count()) or overlaps(*a))
    docs = []
    for i in range(30):
        shared = [f"s{i}x{j}" for j in range(150)]
        docs += [(2 * i + k, " ".join(shared + [f"u{i}x{k}x{j}" for j in range(60)])) for k in (0, 1)]
    docs += [(100, docs[0][1] + " more"), (101, docs[7][1].replace("x100 ", "new "))]
    assert run(spark, docs) == plain.near_duplicates(docs)
    assert sum(rows) <= 6, rows
