import random

from quillrank import Workspace
from quillrank.llm import alignment
from quillrank.llm.alignment import aligned, id_pairs
from tests.llm import plain

SCHEMA = "doc_id long, text string, keys string, block int, n_a string"


def run(spark, docs):
    frame = spark.createDataFrame([(*d, "x", 1, None) for d in docs], SCHEMA)
    with Workspace(spark) as workspace:
        return sorted([tuple(r) for r in aligned(frame, workspace).collect()], key=repr)


def corpus():
    rng = random.Random(3)
    words = "the of stone Wasser été naïve 東京 😀 tokenization <|endoftext|> </s> <0x41> ▁ a\tb  \n {}[]=> 12345 aaaaaaaa ﬁn Å".split(" ")
    docs = [(i, " ".join(rng.choice(words) for _ in range(rng.randrange(1, 60)))) for i in range(40)]
    docs += [(50, None), (51, ""), (52, " "), (53, "▁"), (54, "x" * 3000), (55, "​﻿ab\x00c"), (56, "é" * 500), (57, "a" + " " * 5000 + "b")]
    return [*docs, docs[0], docs[0], (None, docs[1][1]), (60, "the stone " * 4000), (61, "".join(rng.choice("abcxyz019") for _ in range(2500)))]


def test_like_brute_force(spark):
    docs = corpus()
    got = run(spark, docs)
    assert got == plain.alignment(docs, alignment.load(alignment.TOKENIZERS))
    assert any(r[1] == 0 for r in got) and any(r[4] > max(r[1], r[2]) for r in got)


def test_pieces_are_whole():
    """However few pairs are made at once, they are the same."""
    texts = [t or "" for _, t in corpus()]
    a_side, b_side, a_tokens, b_tokens = alignment.load(alignment.TOKENIZERS)
    texts = [t for t in texts if len(t) > 20 and t.isascii()]
    a = alignment.Encoded([a_side.encode(f" {t}") for t in texts], a_tokens)
    b = alignment.Encoded(b_side.encode(texts), b_tokens)
    groups = alignment.groups_of(a, b)

    def made(size):
        old, alignment.PAIRS = alignment.PAIRS, size
        try:
            tables = list(alignment.links(a, b, *groups))
        finally:
            alignment.PAIRS = old
        return len(tables), sorted(r for t in tables for r in zip(*t.to_pydict().values()))

    few, many = made(1 << 30), made(100)
    assert few[0] == 1 < many[0] and few[1] == many[1]


def test_id_pairs(spark):
    docs = [(1, "the stone"), (2, "the the water"), (3, "the stone"), (4, None)]
    frame = spark.createDataFrame([(*d, "x", 1, None) for d in docs], SCHEMA)
    with Workspace(spark) as workspace:
        rows = {(r["id_a"], r["id_b"]): (r["documents"], r["is_best"]) for r in id_pairs(frame, workspace).collect()}
    a, b, *_ = alignment.load(alignment.TOKENIZERS)
    the = a.encode(" the")[0], b.encode("the")[0]
    assert rows[the] == (3, True)


def test_both_libraries_agree():
    a, *_ = alignment.load(alignment.TOKENIZERS)
    texts = [t for _, t in corpus() if t] + [" " * 1200 + "x", "\n\t" * 700, "it's they'll \u00a0\u3000 \u0301x", "<|endoftext|>"]
    assert a.fast and [a.encode(t) for t in texts] == [a.whole.encode(t, add_special_tokens=False).ids for t in texts]


def test_empty(spark):
    assert run(spark, []) == []
