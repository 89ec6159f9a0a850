import random

import pytest

from quillrank import Workspace
from quillrank.llm import substring_dedup
from quillrank.llm.queries import LLM_QUERIES
from quillrank.llm.substring_dedup import repeats
from quillrank.sources.tables import read_table
from tests.llm import plain

SCHEMA = "doc_id long, text string, name string, place int, first string"


def run(spark, docs):
    frame = spark.createDataFrame([(*d, "x", 1, None) for d in docs], SCHEMA)
    with Workspace(spark) as workspace:
        rows = repeats(frame, workspace).collect()
    for row in rows:
        assert sum(s["end"] - s["start"] for s in row["removed"]) == row["n_removed"]
    return sorted([tuple(r)[:4] for r in rows], key=repr)


def corpus(seed):
    rng = random.Random(seed)
    passages = [[f"{rng.choice('abc')}{rng.randrange(400)}" for _ in range(rng.choice([49, 50, 51, 75, 160]))] for _ in range(6)]
    docs = []
    for i in range(60):
        found = []
        for _ in range(rng.randrange(5)):
            found += [f"own{i}-{rng.randrange(9)}" for _ in range(rng.choice([0, 3, 60]))]
            passage = rng.choice(passages)
            low = rng.choice([0, 0, rng.randrange(len(passage))])
            found += passage[low : low + rng.choice([49, 50, 60, 999])]
        docs.append((i * 7 % 61, rng.choice([" ", "\n\n", "\t "]).join(found)))
    docs += [(100, None), (101, ""), (102, "one"), (103, "é " * 300), (104, "é " * 400), (None, docs[5][1]), docs[6], docs[6]]
    docs += [(docs[7][0], " ".join(passages[4] + passages[3]))]
    return docs


@pytest.mark.parametrize("seed, frequent", [(1, 1e-5), (2, 0.01), (3, 0.1)])
def test_like_brute_force(spark, monkeypatch, seed, frequent):
    monkeypatch.setattr(substring_dedup, "FREQUENT", frequent)
    docs = corpus(seed)
    got = run(spark, docs)
    assert got == plain.repeats(docs) and sum(r[2] for r in got) > 1000


def test_empty(spark):
    assert run(spark, []) == []


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    docs = [tuple(r) for r in read_table(spark, folder, "documents").select("doc_id", "text").collect()]
    rows = LLM_QUERIES["op7_substring_dedup"](spark, folder).select("doc_id", "n_words", "n_removed", "kept_sha256").collect()
    assert sorted([tuple(r) for r in rows], key=repr) == plain.repeats(docs)


def test_many_texts_under_one_id(spark):
    """Each of 30,000 texts of one id holds the same 50 words of another document, somewhere, and nothing else of it."""
    passage = [f"p{i}" for i in range(50)]
    docs = [(1, " ".join(passage))]
    for i in range(30_000):
        before = [f"u{i}x{j}" for j in range(i % 7)]
        docs.append((2, " ".join([*before, *passage, f"v{i}"])))
    got = run(spark, docs)
    assert len(got) == 30_001 and {row[2] for row in got if row[0] == 2} == {50}
    assert got == plain.repeats(docs)
