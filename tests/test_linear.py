"""Centred moments: merging in any order, and R^2 of columns far from zero."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.operators import linear as L
from quarry.operators import sampling as SA


def test_merged_moments_equal_those_of_all_rows():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(500, 4)) + 1e6
    cuts = np.sort(rng.integers(0, 500, 9))
    parts = [L.moments_of(p) for p in np.split(x, cuts)]
    rng.shuffle(parts)
    while len(parts) > 1:
        parts.append(L.merged(parts.pop(0), parts.pop(0)))
    n, mean, co = parts[0]
    d = x - x.mean(0)
    assert n == 500 and np.allclose(mean, x.mean(0), rtol=1e-14) and np.allclose(co, d.T @ d, rtol=1e-9, atol=1e-6)


def test_r2_of_targets_near_1e8(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(4000, 3)) + np.array([0.0, 1e6, -50.0])
    y = 1e8 + (x - x.mean(0)) @ np.array([0.6, -0.3, 0.2]) + rng.normal(scale=0.7, size=4000)
    df = spark.createDataFrame([(i, *map(float, r), float(t)) for i, (r, t) in enumerate(zip(x, y, strict=True))],
                               "id long, a double, b double, c double, y double").repartition(7)
    df = SA.split_half(df, "id")
    out = L.linreg(spark, df, ["a", "b", "c"], ["y"])
    split = np.array([r.split == "train" for r in df.orderBy("id").collect()])
    d, t = x - x[split].mean(0), y - 1e8
    beta = np.linalg.lstsq(np.c_[np.ones(split.sum()), d[split]], t[split], rcond=None)[0]
    want = [1 - ((t[s] - np.c_[np.ones(s.sum()), d[s]] @ beta) ** 2).sum() / ((t[s] - t[s].mean()) ** 2).sum() for s in (split, ~split)]
    got = out["scores"].first()
    assert abs(got.r2_train - want[0]) < 1e-9 and abs(got.r2_test - want[1]) < 1e-9
    coefs = {r.feature: r.coef for r in out["coefficients"].collect()}
    assert np.allclose([coefs["a"], coefs["b"], coefs["c"]], beta[1:], atol=1e-9)


def test_constant_columns_missing_values_and_no_test_rows(spark):
    rows = [(i, float(i), 3.0, 2.0 * i + 1, "train") for i in range(20)] + [(99, None, 3.0, 5.0, "train"), (98, 4.0, 3.0, None, "test")]
    df = spark.createDataFrame(rows, "id long, a double, k double, y double, split string")
    out = L.linreg(spark, df, ["a", "k"], ["y"])
    score = out["scores"].first()
    assert score.r2_train == pytest.approx(1.0) and score.r2_test is None    # NaN comes back as NULL
    coefs = {r.feature: r.coef for r in out["coefficients"].collect()}
    assert coefs == pytest.approx({"intercept": 1.0, "a": 2.0, "k": 0.0})
    drops = {r.removed: r.drop_train for r in out["ablation"].collect()}
    assert drops["a"] == pytest.approx(1.0) and drops["k"] == pytest.approx(0.0)


def test_null_keys_draw_apart(spark):
    df = spark.range(400).select(F.lit(None).cast("string").alias("k"), F.col("id").alias("v"))
    n = SA.sample_fraction(df, "k", 0.5).count()
    assert 140 < n < 260 and n == SA.sample_fraction(df, "k", 0.5).count()
