"""Series statistics and PCA against numpy on a small fixture."""

import numpy as np
from pyspark.sql import functions as F

from quarry.operators import series as S

ROWS = [
    ("s1", "T", 2000, [1.0, 2.0, 3.0, 4.0]),
    ("s2", "T", 2000, [2.0, 1.0, 4.0, 3.0]),
    ("s3", "T", 2000, [0.0, 0.5, None, 2.0]),
    ("s4", "T", 2000, [3.0, 3.5, 1.0, 0.0]),
    ("s5", "T", 2000, [1.5, 2.5, 2.0, 1.0]),
]


def frame(spark):
    return spark.createDataFrame(ROWS, "station string, measurement string, year int, values array<double>")


def pairwise_cov(x):
    s = x.shape[1]
    c = np.zeros((s, s))
    for i in range(s):
        for j in range(s):
            m = ~np.isnan(x[:, i]) & ~np.isnan(x[:, j])
            a, b = x[m, i], x[m, j]
            c[i, j] = (a * b).mean() - a.mean() * b.mean()
    return c


def test_covariance_matches_brute_force(spark):
    x = np.array([[np.nan if v is None else v for v in r[3]] for r in ROWS])
    want = pairwise_cov(x)
    got = np.zeros_like(want)
    for r in S.covariance(frame(spark)).collect():
        got[r.i, r.j] = r.cov
    assert np.allclose(got, want)


def test_covariance_keeps_digits_on_large_means(spark):
    rows = [(a, "T", y, [1e8 + v, 1e8 - v, None]) for y, (a, v) in enumerate(zip("abc", (0.0, 1.0, 2.0)))]
    got = {(r.i, r.j): r.cov for r in S.covariance(spark.createDataFrame(rows, frame(spark).schema)).collect()}
    assert abs(got[0, 0] - 2 / 3) < 1e-6 and abs(got[0, 1] + 2 / 3) < 1e-6
    assert got[0, 2] is None and got[2, 2] is None   # a slot that no series has


def test_pca_eigenpairs_and_explained_variance(spark):
    x = np.array([[np.nan if v is None else v for v in r[3]] for r in ROWS])
    vals = np.sort(np.linalg.eigvalsh(pairwise_cov(x)))[::-1]
    basis = S.series_pca(frame(spark))
    got = [r.eigval for r in basis.orderBy("k").collect()]
    assert np.allclose(got, vals)
    for r in basis.collect():   # sign rule: largest entry positive
        v = np.array(r.eigvec)
        assert v[np.argmax(np.abs(v))] > 0
    ev = [r.explained for r in S.explained_variance(basis, 9).orderBy("k").collect()]
    assert abs(ev[-1] - 1.0) < 1e-9
    # with a missing slot the pairwise matrix may have a negative eigenvalue;
    # on complete series it is positive semi-definite and the share is monotone
    complete = frame(spark).where(~F.exists("values", lambda v: v.isNull()))
    ev = [r.explained for r in S.explained_variance(S.series_pca(complete), 9).orderBy("k").collect()]
    assert all(b >= a - 1e-12 for a, b in zip(ev, ev[1:])) and abs(ev[-1] - 1.0) < 1e-9


def test_reconstruction_error_is_null_with_missing_slot(spark):
    s = frame(spark)
    stats, basis = S.slot_stats(s), S.series_pca(s)
    err = {r.station: r.error for r in S.reconstruction_error(s, stats, basis, 3).collect()}
    assert err["s3"] is None and err["s1"] is not None
    full = S.reconstruction_error(s, stats, basis, 4).collect()
    assert all(r.error is None or r.error < 1e-9 for r in full)   # all vectors rebuild exactly
    ext = S.extreme_residuals(S.reconstruction_error(s, stats, basis, 1), 2).collect()
    assert len(ext) == 4 and all(r.station != "s3" for r in ext)


def test_histogram_keeps_both_ends(spark):
    s = frame(spark)
    scal = spark.createDataFrame([("T", 0.0, 4.0)], "measurement string, low100 double, high100 double")
    h = {r.bin: r.cnt for r in S.value_histogram(s, scal, 4).collect()}
    assert sum(h.values()) == 19 and h[3] >= 1    # 4.0 == high100 falls in the last bin


def test_slot_counts_and_length(spark):
    s = frame(spark)
    ne = {r.slot: r.ne for r in S.slot_stats(s).collect()}
    assert ne == {0: 5, 1: 5, 2: 4, 3: 5}
    v = S.valid_length(s, 4).first()
    assert (v.n_valid, v.n_invalid) == (5, 0)


def test_require_length_fails_on_wrong_length(spark):
    import pytest
    bad = spark.createDataFrame([("s", "T", 2000, [1.0, 2.0])], "station string, measurement string, year int, values array<double>")
    with pytest.raises(Exception):
        S.require_length(bad, 4).collect()
    assert S.require_length(frame(spark), 4).count() == 5


def test_quantiles_are_exact_on_many_values(spark):
    n = 40_003
    rows = spark.range(n).select(F.col("id").alias("station"), F.lit("T").alias("measurement"), F.lit(2000).alias("year"),
                                 F.array(F.when(F.col("id") == 0, 1e12).otherwise(F.pmod(F.xxhash64("id"), F.lit(30_011)) / 7.0),
                                         F.lit(None).cast("double")).alias("values"))
    few = spark.createDataFrame([("s", None, 2000, [5.0, 5.0, 4.0])], rows.schema.simpleString()[7:-1].replace("station:bigint", "station:string"))
    rows = rows.withColumn("station", F.col("station").cast("string")).unionByName(few)
    x = sorted(r.value for r in S.slot_values(rows).where("measurement = 'T'").select("value").collect())
    want = [x[-(-n * p // 1000) - 1] for p in (1, 10, 990, 999)]
    for how in ({}, {"bits": (6, 28, 30), "small": 0}, {"bits": (33, 31), "small": 10}):   # how cells are cut changes no value
        scal = S.scalar_stats(rows, **how)
        got = {r.measurement: [r.low1000, r.low100, r.high100, r.high1000] for r in scal.collect()}
        assert got == {"T": want, None: [4.0, 4.0, 5.0, 5.0]}
    h = S.value_histogram(rows, scal).where("measurement = 'T'").agg(F.sum("cnt")).first()[0]
    assert h == sum(want[1] <= v <= want[2] for v in x)


def test_keys_keep_the_order_of_doubles():
    x = np.array([-np.inf, -1e300, -2.5, -1e-310, -0.0, 0.0, 1e-310, 0.1, 2.5, 1e300, np.inf])
    keys = S.ordered_keys(x)
    assert (np.diff(keys.astype(object)) >= 0).all() and keys[4] == keys[5] and len(set(keys.tolist())) == 10
    assert [S.value_of_key(int(k)) for k in keys] == x.tolist()


def test_negative_values_ties_and_short_series(spark):
    rows = [("s", "T", 2000, [-3.0, -3.0, float("nan"), None]), ("t", "T", 2000, []), ("u", "T", 2000, [0.0, -0.0, 7.5]), ("v", "E", 2000, [None])]
    scal = S.scalar_stats(spark.createDataFrame(rows, frame(spark).schema))
    assert [tuple(r) for r in scal.select("measurement", "low1000", "low100", "high100", "high1000").collect()] == [("T", -3.0, -3.0, 7.5, 7.5)]
    assert S.scalar_stats(frame(spark).limit(0)).collect() == []


def test_no_series_is_dealt_by_measurement(spark):
    s = frame(spark)
    stats, basis, scal = S.slot_stats(s), S.series_pca(s), S.scalar_stats(s)
    for df in (S.in_range(s, scal), S.project_coeffs(s, stats, basis), S.reconstruction_error(s, stats, basis)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan, plan


def test_scan_opens_only_the_leaves_it_lists(spark, tmp_path):
    from quarry.sources import files as FI
    nested = frame(spark).groupBy("station").agg(F.collect_list(F.struct("measurement", "year", "values")).alias("years"))
    nested.write.parquet(str(tmp_path / "s"))
    few = FI.scan_station_series(spark, str(tmp_path / "s"), ("measurement", "year"))
    plan = few._jdf.queryExecution().executedPlan().toString()
    schema = plan[plan.index("ReadSchema"):]
    assert "measurement" in schema and "year" in schema and "values" not in schema, schema
    assert sorted(map(tuple, few.collect())) == sorted(r[:3] for r in ROWS)
    whole = FI.scan_station_series(spark, str(tmp_path / "s")).collect()
    assert sorted(map(tuple, whole), key=str) == sorted(ROWS, key=str)
    p = spark.createDataFrame([("a", [1.0], [2.0], [3.0], 0.0, 0.0, 0.0, 0.0), ("b", [1.0], None, [3.0], 0.0, 0.0, 0.0, 0.0)], FI.STATION_PROJECTIONS)
    p.write.parquet(str(tmp_path / "p"))
    got = FI.scan_station_projections(spark, str(tmp_path / "p"))
    assert [tuple(r) for r in got.collect()] == [("a", [1.0, 2.0, 3.0])]
    assert "latitude" not in got._jdf.queryExecution().executedPlan().toString()


def test_scan_query_gives_every_series_with_its_values(spark, tmp_path):
    from quarry.plans import series_queries as Q
    spark.sql("""SELECT * FROM VALUES (1L, TIMESTAMP_NTZ '2024-01-01 01:00:00', 7L, 'click', 2.0D, ''),
        (2L, TIMESTAMP_NTZ '2024-01-02 02:00:00', 7L, 'click', 4.0D, ''), (3L, TIMESTAMP_NTZ '2024-01-01 07:00:00', 7L, 'click', 0.12345678D, ''),
        (4L, TIMESTAMP_NTZ '2024-05-01 00:00:00', 8L, 'view', 1.0D, '') t(event_id, ts, user_id, event_type, value, props)
        """).write.parquet(str(tmp_path / "events.parquet"))
    got = sorted(tuple(r) for r in Q.q_scan_station_series(spark, str(tmp_path)).collect())
    assert got == [("u7", "click", 2024, [3.0, None, 0.123457]), ("u8", "view", 2024, [1.0])]
