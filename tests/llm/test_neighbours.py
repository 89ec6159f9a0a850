import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from quillrank.llm.neighbours import nearest

SCHEMA = "vec_id long, embedding array<float>, label int, shard string, dim int"


def plain(rows, k=5, step=10):
    known = {(i, tuple(np.float32(x) for x in v)) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)}
    asked = {}
    for i, v in known:
        if i % step == 0:
            asked[i] = min(asked.get(i, v), v)

    def cosine(a, b):
        dot = left = right = 0.0
        for x, y in zip(map(float, a), map(float, b)):
            dot, left, right = dot + x * y, left + x * x, right + y * y
        return dot / (math.sqrt(left) * math.sqrt(right))

    out = set()
    for q, v in asked.items():
        best = {}
        for i, u in known:
            if i != q and len(u) == len(v):
                best[i] = max(best.get(i, -2.0), cosine(v, u))
        for rank, (i, score) in enumerate(sorted(best.items(), key=lambda x: (-x[1], x[0]))[:k], 1):
            out.add((q, rank, i, score))
    return out


def vectors(seed, n=400):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 1) for _ in range(6)] for _ in range(8)]
    rows = [(i, [x + rng.gauss(0, 0.2) for x in rng.choice(centres)]) for i in range(n)]
    same = rows[3][1]
    rows += [(1000 + i, same) for i in range(120)] + [(2000 + i, [x * 2**i for x in same]) for i in range(-20, 20)]
    rows += [(10, rows[11][1]), rows[20], rows[20], (None, same), (3000, None), (3010, []), (3020, [0.0] * 6), (3030, [1.0, None] * 3)]
    return rows + [(3040, [float("nan")] * 6), (3050, [float("inf")] * 6), (3060, [1.0, 2.0]), (3070, [2.0, 1.0])]


def run(spark, rows, **how):
    frame = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], SCHEMA)
    return {tuple(r) for r in nearest(frame, F.col("vec_id") % 10 == 0, **how).collect()}


@pytest.mark.parametrize("how", [{}, {"shard_rows": 100, "block_rows": 7}])
def test_exact(spark, how):
    rows = vectors(1)
    assert run(spark, rows, **how) == plain(rows)


@pytest.mark.parametrize("how", [{}, {"shard_rows": 20}])
def test_repeated_row_beside_equal_vectors(spark, how):
    same, zero = [1.0, 0.5, 0.0], [1.0, 0.5, -0.0]
    rows = [(0, same)] * 10 + [(i, same) for i in range(1, 9)] + [(10, zero)] * 10 + [(20 + i, [1.0, float(i), 2.0]) for i in range(30)]
    got = run(spark, rows, **how)
    assert got == plain(rows) and {i for q, _, i, _ in got if q == 0} == {1, 2, 3, 4, 5}


def test_relaxed(spark):
    rng = random.Random(2)
    rows = [(i, [rng.gauss(0, 1) for _ in range(6)]) for i in range(3000)]
    exact, found = ({(q, i) for q, _, i, _ in run(spark, rows, factor=f)} for f in (1.0, 1.5))
    assert exact == {(q, i) for q, _, i, _ in plain(rows)} and 0.9 <= len(found & exact) / len(exact) <= 1


def test_few(spark):
    assert run(spark, []) == set()
    assert run(spark, [(10, [1.0, 0.0]), (11, [1.0, 1.0])]) == plain([(10, [1.0, 0.0]), (11, [1.0, 1.0])])
