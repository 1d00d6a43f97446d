"""Hard-negative mining against plain Python integers."""
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from starloom.llm import hard_negatives
from starloom.llm.hard_negatives import Packed, mine


@pytest.mark.parametrize("reach,length", [(1, 1), (300, 64), (30_000, 7), (2 ** 23, 300), (2 ** 40, 5)])
def test_packed_products_are_exact(reach, length):
    rng = random.Random(reach)
    kind = np.int64 if reach < 2 ** 24 else object
    rows = np.array([[rng.randint(-reach, reach) for _ in range(length)] for _ in range(37)], dtype=kind)
    anchors = np.array([[rng.randint(-reach, reach) for _ in range(length)] for _ in range(11)] + [[reach] * length, [-reach] * length],
                       dtype=kind)
    p = Packed(rows, reach)
    assert p.fields >= (2 if reach <= 300 else 1)
    limit = 2 ** 63 - 1
    want = [[max(-limit, min(limit, sum(int(a) * int(c) for a, c in zip(x, y)))) for y in rows] for x in anchors]
    assert p.scores(anchors).tolist() == want


def by_hand(rows, scale=256):
    seen = {}
    for i, label, v in rows:
        if i is None or label is None or not v or any(x is None or not math.isfinite(x) for x in v):
            continue
        seen[i, label, tuple(v)] = [math.floor(scale * x) for x in v]
    limit = 2 ** 63 - 1
    score = lambda a, b: max(-limit, min(limit, sum(x * y for x, y in zip(seen[a], seen[b]))))
    out = []
    for a in seen:
        if a[0] % 100:
            continue
        others = [(c, score(a, c)) for c in seen if c != a and len(c[2]) == len(a[2])]
        others.sort(key=lambda t: (-t[1], t[0][0]))
        for p, ps in [t for t in others if t[0][1] == a[1]][:5]:
            fit = [t for t in others if t[0][1] != a[1] and 80 * ps <= 100 * t[1] <= 100 * ps][:5]
            out += [(a[0], p[0], n + 1, c[0], ps, s) for n, (c, s) in enumerate(fit)]
    return sorted(out)


def frame(spark, rows):
    return spark.createDataFrame([(i, label, v, 1, 2, "x", 3) for i, label, v in rows],
                                 "vec_id long, label int, embedding array<float>, key int, row int, v string, length int")


def found(df):
    return sorted(tuple(r) for r in df.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score",
                                              "negative_score").collect())


def vectors(seed, n=400, length=6):
    rng = random.Random(seed)
    centers = [[rng.uniform(-1, 1) for _ in range(length)] for _ in range(4)]
    return [(i, rng.randrange(4), [round((c + rng.uniform(-.3, .3)) * 64) / 64 for c in centers[rng.randrange(4)]]) for i in range(n)]


def test_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(hard_negatives, "ANCHOR_BLOCK", 3)
    monkeypatch.setattr(hard_negatives, "ROW_BLOCK", 50)
    monkeypatch.setattr(hard_negatives, "_TOGETHER", 2)
    rows = vectors(1)
    rows += [(500, 1, None), (600, None, [1.0] * 6), (None, 1, [1.0] * 6), (700, 1, []), (800, 1, [1.0, None] + [0.0] * 4),
             (900, 2, [float("inf")] + [0.0] * 5), (1000, 2, [float("nan")] * 6), (1100, 3, [0.0] * 6), (1200, 1, [0.5, 0.25]),
             (1201, 1, [0.5, 0.25]), (1202, 2, [0.5, 0.25]), (1203, 0, [0.5, 0.2])]
    rows += rows[100:140] * 3                                  # repeated rows
    rows += [(2000 + i, i % 3, rows[100][2]) for i in range(60)]   # ties
    got = found(mine(frame(spark, rows), F.col("vec_id") % 100 == 0))
    assert got == by_hand(rows) and len(got) > 50


def test_large_components(spark):
    rng = random.Random(4)
    rows = [(i, i % 2, [rng.uniform(-1, 1) * 10.0 ** rng.choice([0, 6, 9]) for _ in range(4)]) for i in range(101)]
    rows = [(i, label, np.array(v, dtype=np.float32).astype(float).tolist()) for i, label, v in rows]
    assert found(mine(frame(spark, rows), F.col("vec_id") % 100 == 0)) == by_hand(rows)


def test_nothing(spark):
    assert found(mine(frame(spark, []), F.col("vec_id") % 100 == 0)) == []
    assert found(mine(frame(spark, [(1, 1, [1.0]), (2, 2, [1.0])]), F.col("vec_id") % 100 == 0)) == []
    assert found(mine(frame(spark, [(0, 1, [1.0]), (2, 2, [1.0])]), F.col("vec_id") % 100 == 0)) == []
