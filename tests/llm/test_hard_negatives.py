"""Exact products against unbounded integers, and the mining against brute force."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.llm import hard_negatives as hn

SCHEMA = "vec_id bigint, embedding array<float>, label int, id string, key int, score int"


@pytest.mark.parametrize(("dim", "top"), [(1, 3), (3, 1 << 20), (64, 256), (64, 2000), (200, 300), (768, 100_000), (2500, 9000)])
def test_products_are_exact(dim, top):
    rng = np.random.default_rng(dim)
    a, b = (rng.integers(-top, top, (17, dim), endpoint=True).astype(float) for _ in range(2))
    a[0], b[0] = top, -top
    b[1] = top
    primes = hn.primes_for(dim, dim * top * top)
    assert math.prod(primes) > 4 * dim * top * top and len(set(primes)) == len(primes)
    assert all(min(dim, hn.DEPTH) * ((p + 1) // 2) ** 2 <= 1 << 24 for p in primes)
    got = hn.scores(hn.residues(a, primes), hn.residues(b, primes), primes)
    want = [[sum(int(x) * int(y) for x, y in zip(u, v, strict=True)) for v in b] for u in a]
    assert [[int(x) for x in row] for row in got] == want


def brute(rows, every=100, n_pos=5, n_neg=10, low=30, high=90):
    own = [(i, lab, [math.floor(256 * float(np.float32(x))) for x in e]) for i, e, lab in rows
           if i is not None and lab is not None and e is not None and all(x is not None and math.isfinite(x) for x in e)]
    out = []
    for i, lab, e in {(i, lab, tuple(e)) for i, lab, e in own if i % every == 0}:
        near = sorted((-sum(x * y for x, y in zip(e, f, strict=False)), j, m) for j, m, f in own)
        for ps, p, _ in [x for x in near if x[2] == lab and x[1] != i][:n_pos]:
            fit = [x for x in near if x[2] != lab and low * -ps <= 100 * -x[0] <= high * -ps][:n_neg]
            out += [(i, p, -ps, j, -s, k) for k, (s, j, _) in enumerate(fit, 1)]
    return sorted(out)


def mined(spark, rows, every=100, **how):
    table = spark.createDataFrame([(*r, "x", 1, 2) for r in rows], SCHEMA)
    return sorted(tuple(r) for r in hn.mine(table, F.col("vec_id") % every == 0, **how).collect())


def random_rows(seed, n, dim=6, labels=4):
    rng = random.Random(seed)
    rows = [(i, [rng.choice([-1.0, -0.5, 0.0, 0.25, rng.uniform(-1, 1)]) for _ in range(dim)], rng.randrange(labels)) for i in range(n)]
    return rows + [(i + n, *r[1:]) for i, r in enumerate(rows[:n // 4])]     # ties


@pytest.mark.parametrize("chunk", [hn.CHUNK, 3])
def test_against_brute_force(spark, chunk, monkeypatch):
    rows = random_rows(1, 160)
    got = mined(spark, rows, every=10, chunk=chunk)
    assert got == brute(rows, every=10) and len(got) > 300


def test_small_blocks(spark):
    rows = random_rows(2, 90, dim=70, labels=2)
    assert mined(spark, rows, every=7, n_positives=3, n_negatives=2, low=-20, high=95) == brute(rows, 7, 3, 2, -20, 95)


def test_best_keeps_the_first():
    rng = random.Random(3)
    best, rows = hn.Best(4, 3, np.full(4, -100, np.int64)), []
    best.limit = 5
    for _ in range(40):
        part = [(rng.randrange(4), rng.randrange(10), rng.randrange(50)) for _ in range(rng.randrange(6))]
        rows += part
        best.add(*(np.array(x, np.int64) for x in zip(*part, strict=True)) if part else [np.zeros(0, np.int64)] * 3)
    best.settle()
    want = [(k, s, i) for k in range(4) for s, i in sorted(((s, i) for q, s, i in rows if q == k), key=lambda x: (-x[0], x[1]))[:3]]
    assert list(zip(best.key, best.score, best.ident, strict=True)) == want


def test_small_cases(spark):
    a, nan, inf = [1.0, 0.5, 0.0], float("nan"), float("inf")
    rows = [(0, a, 1), (1, [0.9, 0.5, 0.0], 1), (1, [0.9, 0.5, 0.0], 1), (2, [0.5, 0.4, 0.1], 2), (2, [0.5, 0.4, 0.1], 2), (3, a, None),
            (4, None, 2), (5, [None, 1.0, 0.0], 2), (6, [nan, 1.0, 0.0], 2), (7, [inf, 1.0, 0.0], 2), (None, a, 2), (8, [0.6], 2),
            (100, [], 2), (200, [-1.0, 0.0, 0.0], 3), (0, a, 1), (300, a, 9), (400, [0.0] * 3, 1)]
    got = mined(spark, rows)
    assert got == brute(rows) and {r[0] for r in got} >= {0}
    assert mined(spark, []) == mined(spark, rows[:1]) == mined(spark, [(1, a, 1), (2, a, 2)]) == []
    with pytest.raises(ValueError):
        mined(spark, [(0, [1e30], 1)])
