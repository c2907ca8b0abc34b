"""Carried distances, distance bounds and prefix counts against their plain forms."""

from collections import Counter

import numpy as np
import pytest

from quarry.operators import clusters as C


def frame(spark, pts):
    return spark.createDataFrame([(i, [float(v) for v in p]) for i, p in enumerate(pts)], "id long, vec array<double>")


@pytest.fixture(scope="module")
def points():
    rng = np.random.default_rng(21)
    blobs = rng.normal(scale=4, size=(6, 5))
    pts = np.vstack([b + rng.normal(size=(60, 5)) for b in blobs])
    return np.vstack([pts, pts[:20], np.round(pts[:40])])      # repeated rows and ties


def test_seeding_reads_once_and_computes_one_distance_a_round(spark, points):
    read, counted = spark.sparkContext.accumulator(0), spark.sparkContext.accumulator(0)

    def watch(batches):
        for b in batches:
            read.add(b.num_rows)
            yield b

    df = frame(spark, points)
    watched = df.mapInArrow(watch, df.schema)
    k, runs = 4, 3
    centres, ids = C.kmeanspp_seed(watched, k, runs, 17, counted=counted)
    assert read.value == len(points)
    assert counted.value == len(points) * runs * (k - 1)
    for t in range(k):       # the picks of the expression form, which starts over in each round
        chosen = [run[:t] for run in centres]
        want = {r.run: r.id for r in C.seed_round_expr(df, chosen if t else None, runs, t, 17).collect()}
        assert {r: ids[r][t] for r in range(runs)} == want


@pytest.mark.parametrize("fresh", [100, 3])
def test_bounded_steps_equal_plain_steps(spark, points, monkeypatch, fresh):
    monkeypatch.setattr(C, "FRESH", fresh)
    df, k, runs = frame(spark, points), 5, 4
    got = C.kmeans_multi(df, k, runs, seed=5, converge_dist=1e-9, max_iter=40)
    plain = [[c for c in run] for run in C.kmeanspp_seed(df, k, runs, 5)[0]]
    shifts = []
    for _ in range(got["iterations"]):
        new = C._collect_centres(C.lloyd_sums(df, plain), plain)
        shifts.append(C.max_shift(plain, new))
        plain = new
    assert np.allclose(got["centres"], plain, rtol=0, atol=1e-10) and np.allclose(got["shifts"], shifts, atol=1e-10)
    whole = len(points) * runs * k
    assert len(got["distances"]) == got["iterations"] and got["distances"][0] == whole
    assert sum(got["distances"]) < 0.6 * whole * got["iterations"] and got["converged"]


def test_bounds_never_change_a_label():
    rng = np.random.default_rng(8)
    x = np.round(rng.normal(size=(300, 2)), 1)                 # many ties
    cs = np.round(rng.normal(size=(3, 4, 2)), 1)
    cs[1, 2] = cs[1, 0]                                        # two equal centres
    label, upper, lower = C._first_bounds(x, cs)
    for _ in range(12):
        new = np.round(cs + rng.normal(scale=rng.choice([0.0, 0.05, 0.5]), size=cs.shape), 1)
        moved = np.sqrt(((new - cs) ** 2).sum(2))
        label, upper, lower, work = C._next_bounds(x, label, upper, lower, new, moved)
        want, near, other = C._first_bounds(x, new)
        assert (label == want).all() and (upper >= near - 1e-12).all() and (lower <= other + 1e-12).all()
        cs = new


def test_one_centre(spark):
    res = C.kmeans_multi(frame(spark, [[0.0, 0.0], [2.0, 2.0]]), 1, 2, seed=1, converge_dist=1e-9)
    assert res["converged"] and np.allclose(res["centres"], [[[1.0, 1.0]]] * 2)


@pytest.mark.parametrize("partitions", [1, 7])
def test_signature_entropy_from_prefix_counts(spark, partitions):
    rng = np.random.default_rng(3)
    labels = rng.integers(0, 3, (200, 6)) * (rng.random((200, 6)) < 0.4)
    df = spark.createDataFrame([(i, [int(v) for v in r]) for i, r in enumerate(labels)], "id long, labels array<int>").repartition(3)
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    try:
        got = {r.i: r.entropy for r in C.signature_entropy(df, 6).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    for i in range(1, 7):
        p = np.array(list(Counter(map(tuple, labels[:, :i].tolist())).values())) / len(labels)
        assert got[i] == pytest.approx(-(p * np.log2(p)).sum(), abs=1e-10)
    one = C.signature_entropy(df.limit(1), 6).collect()
    assert sorted(r.i for r in one) == [1, 2, 3, 4, 5, 6] and all(r.entropy == 0 for r in one)


def test_numpy_labels_equal_the_expression_form(spark, points):
    centres = [points[[0, 70, 140]].tolist(), points[[5, 5, 200]].tolist()]
    df = frame(spark, points)
    a = {r.id: (r.labels, r.d2) for r in C.kmeans_assign(df, centres).collect()}
    b = {r.id: ([n.j for n in r.nearest], [n.d2 for n in r.nearest]) for r in C.assign(df, centres).collect()}
    assert {i: x[0] for i, x in a.items()} == {i: x[0] for i, x in b.items()}
    assert all(np.allclose(a[i][1], b[i][1]) for i in a)
