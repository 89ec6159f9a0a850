import random

import pytest

from quillrank import Workspace
from quillrank.llm.prefix_trie import contracted, list_ranks, prefix_trie
from pyspark.sql import functions as F
from tests.llm import plain

SCHEMA = "conv_id long, turn long, role string, text string, node string, depth int"


def run(spark, turns):
    frame = spark.createDataFrame([(*t, "x", 1) for t in turns], SCHEMA).repartition(5)
    with Workspace(spark) as workspace:
        return sorted([tuple(r) for r in prefix_trie(frame, workspace).collect()], key=repr)


def corpus(seed):
    rng = random.Random(seed)
    turns = []
    for conv in [*range(0, 120), *range(250, 280), *range(-130, -90), 10**12 + 3]:
        for turn in range(rng.choice([1, 2, 3, 4, 6, 9])):
            turns.append((conv, turn if turn or rng.random() < 0.7 else None, rng.choice(["user", "assistant", None]), rng.choice(["yes", "no", "né", "", None, "why 😀"])))
    turns += [(None, 0, "user", "no id"), (None, 1, None, None)]
    turns += [(777, t, "user", rng.choice(["a", "b"])) for t in range(1500)]  # many turns in one
    turns += [(c, t, "user", "same") for c in range(1000, 1060) for t in range(7)]  # copies
    return turns


@pytest.mark.parametrize("seed", [1, 2])
def test_like_brute_force(spark, seed):
    turns = corpus(seed)
    got = run(spark, turns)
    assert got == plain.prefix_trie(turns)
    assert {r[1] for r in got} >= {0, 1, 5, 100} and max(r[4] for r in got) > 5


def test_repeated_rows_are_turns(spark):
    turns = [(1, 0, "user", "a")] * 20
    numbered = [(1, i, "user", "a") for i in range(20)]
    assert run(spark, turns) == plain.prefix_trie(numbered)


def test_ties_do_not_depend_on_order(spark):
    turns = [(5, 0, "user", t) for t in "abcdefghij"]
    assert run(spark, turns) == run(spark, turns[::-1])


def test_long_text_and_empty(spark):
    turns = [(1, 0, "user", "é" * 2_000_000), (2, 0, "user", "é" * 2_000_000)]
    assert run(spark, turns) == plain.prefix_trie(turns)
    assert run(spark, []) == [] and run(spark, [(None, 1, "user", "a")]) == []


def test_list_ranks(spark):
    rng = random.Random(5)
    ids = list(range(700))
    rng.shuffle(ids)
    rows = [(a, b, 1 + a % 3) for a, b in zip(ids, [*ids[1:], None])]
    left, expected = 0, {}
    for a, _, length in reversed(rows):
        left += length
        expected[a] = left
    frame = spark.createDataFrame(rows, "id long, next long, length long")
    with Workspace(spark) as workspace:
        assert {r["id"]: r["rank"] for r in list_ranks(frame, workspace).collect()} == expected
        placed, shorter = contracted(frame, [F.asc("id")], workspace, "x")
        ranks = {r["id"]: r["rank"] for r in list_ranks(shorter, workspace).collect()}
        assert {r["id"]: ranks[r["head"]] - r["offset"] for r in placed.collect()} == expected
