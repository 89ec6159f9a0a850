import random

import pytest

from quillrank import Workspace
from quillrank.llm.line_dedup import n_removed, without_repeats

SCHEMA = "doc_id long, text string, row int, line string, rank int"


def plain(docs, size):
    """docs in reading order -> sorted [(id, text, lines, removed)]"""
    seen, gone = set(), {}
    order = sorted(range(len(docs)), key=lambda i: (docs[i][0] is None, docs[i][0] or 0, i))
    for i in order:
        lines = [] if docs[i][1] is None else docs[i][1].split("\n")
        gone[i] = set()
        for at in range(len(lines) - size + 1):
            key = tuple(lines[at : at + size])
            if key in seen:
                gone[i].update(range(at, at + size))
            seen.add(key)
    out = []
    for i, (doc_id, text) in enumerate(docs):
        lines = [] if text is None else text.split("\n")
        kept = None if text is None else "\n".join(x for at, x in enumerate(lines) if at not in gone[i])
        out.append((doc_id, kept, len(lines), len(gone[i])))
    return sorted(out, key=repr)


def run(spark, docs, size):
    frame = spark.createDataFrame(spark.sparkContext.parallelize([(*d, 1, "x", 2) for d in docs], 2), SCHEMA)
    with Workspace(spark) as workspace:
        rows = without_repeats(frame, workspace, size).select("doc_id", "text", "n_lines", n_removed().alias("n")).collect()
    return sorted([tuple(r) for r in rows], key=repr)


def corpus(seed):
    rng = random.Random(seed)
    docs = [(i * 7 % 61, "\n".join(rng.choice(["a", "b", "", "c d", f"own {i}", "é"]) for _ in range(rng.randrange(12)))) for i in range(60)]
    docs += [(100, None), (101, ""), (102, "\n"), (103, "\n\n\n\n\n"), (104, "z\n" * 3000), (None, docs[5][1]), (None, docs[5][1]), docs[6], docs[6]]
    return docs + [(105, "\n".join(f"long {i}" for i in range(400))), (106, "x\n" + "\n".join(f"long {i}" for i in range(400)))]


@pytest.mark.parametrize("size", [1, 2, 4])
def test_like_brute_force(spark, size):
    docs = corpus(size)
    got = run(spark, docs, size)
    assert got == plain(docs, size) and sum(r[3] for r in got) > 300


def test_edges(spark):
    assert run(spark, [], 2) == [] and run(spark, [(1, None)], 2) == [(1, None, 0, 0)]
    with pytest.raises(ValueError):
        run(spark, [(1, "a")], 3)


def plain_long(docs, size, words):
    """docs, all with an id -> {id: kept text}; runs of ``size`` lines, or of fewer with ``words`` words"""
    seen, out = set(), {}
    for doc_id, text in sorted(docs):
        lines, gone = text.split("\n"), set()
        for at in range(len(lines)):
            for n in range(1, min(size, len(lines) - at) + 1):
                key = tuple(lines[at : at + n])
                if n == size or sum(len(x.split()) for x in key) >= words:
                    if key in seen:
                        gone.update(range(at, at + n))
                    seen.add(key)
        out[doc_id] = "\n".join(x for at, x in enumerate(lines) if at not in gone)
    return out


@pytest.mark.parametrize("size", [2, 4])
def test_long_runs_of_few_lines(spark, size):
    rng = random.Random(size)
    long, short, part = "w " * 50, "w " * 49, [" ".join(f"{c}{i}" for i in range(20)) for c in "pqr"]
    docs = [(1, long), (2, long), (3, short), (4, short), (5, f"before\n{long}\nafter"), (6, f"{long}\nother\n{long}")]
    docs += [(7, "x7\n" + "\n".join(part) + "\ny7"), (8, "x8\n" + "\n".join(part) + "\ny8"), (9, part[0] + "\nz9"), (10, part[0] + "\nz10")]
    docs += [(20 + i, "\n".join(rng.choice([long, short, *part, "a", f"own {i}"]) for _ in range(rng.randrange(1, 8)))) for i in range(40)]
    got = {r[0]: r[1] for r in run(spark, docs, size)}
    assert got == plain_long(docs, size, 50)
    assert got[2] == "" and got[4] == short and got[5] == "before\nafter" and got[6] == "other"
