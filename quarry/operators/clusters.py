"""k-means++ with many independent runs advanced together.

Points stay where they are read; only small per-task partials and the
R x K centre table move.

- Seeding is exact D^2 sampling by an exponential race: point x wins round t
  of run r when it minimises -ln(u)/D2(x), u a hash uniform of
  (x, r, t, seed). D2 is a column of the persisted points, one number per
  run: a round lowers it by the newest centre only, so the input is read once
  and each point costs one distance per run and round. Each task keeps one
  candidate per run; the per-run minimum is a partial aggregate
  (``seed_round_expr`` is the same round in built-in expressions).
- A Lloyd step keeps with every point, per run, its label, an upper bound of
  the distance to that centre and a lower bound of the distance to any other.
  Moved centres loosen the bounds by the triangle inequality; only points
  whose bounds meet are compared again, so labels are exact. A task shuffles
  R x K x dim sums whatever its number of points; the driver receives those
  sums (size fixed by the parameters) and checks the shift.
- Labels and costs for a final set of centres are computed with numpy on
  Arrow batches (``assign`` is the same in built-in expressions).
"""

from __future__ import annotations

import json

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.functions.hashing import hash_uniform
from quarry.functions.vectors import sq_dist
from quarry.session import local_frame, persisted

CENTRES_TYPE = "array<array<array<double>>>"


def centres_literal(centres: list) -> Column:
    """``centres[run][j]`` as one constant column."""
    return F.from_json(F.lit(json.dumps(centres)), CENTRES_TYPE)


def _nearest(vec: Column, centres: Column) -> Column:
    """Per run: struct(d2, j) of the nearest centre; lowest j on ties."""
    return F.transform(centres, lambda cs: F.array_min(F.transform(
        cs, lambda c, j: F.struct(sq_dist(vec, c).alias("d2"), j.alias("j")))))


def _min_d2(vec: Column, centres: Column) -> Column:
    """Per run: squared distance to the nearest of the centres chosen so far."""
    return F.transform(centres, lambda cs: F.array_min(F.transform(cs, lambda c: sq_dist(vec, c))))


_SEED_SCHEMA = T.StructType([T.StructField("run", T.IntegerType()), T.StructField("key", T.DoubleType()),
                             T.StructField("u", T.DoubleType()), T.StructField("id", T.LongType()),
                             T.StructField("vec", T.ArrayType(T.DoubleType()))])
CHUNK = 512   # rows per distance block: CHUNK x (R x t) x dim doubles at most


def _sq_dists(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Squared distances (rows of x) x (rows of c), from differences, in chunks."""
    out = np.empty((len(x), len(c)))
    for lo in range(0, len(x), CHUNK):
        d = x[lo:lo + CHUNK, None, :] - c[None, :, :]
        out[lo:lo + CHUNK] = np.einsum("ijk,ijk->ij", d, d)
    return out


def _vectors(column: pa.Array) -> np.ndarray:
    """Rows of an array<double> column of one length."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype("float64")
    return flat.reshape(len(column), -1)


def _lists(x: np.ndarray) -> pa.Array:
    """A matrix as an array column."""
    off = np.arange(len(x) + 1, dtype="int32") * x.shape[1]
    return pa.ListArray.from_arrays(pa.array(off), pa.array(np.ascontiguousarray(x).ravel()))


def _race(points: DataFrame, runs: int, t: int, seed: int, id_col: str, vec_col: str) -> DataFrame:
    """``(run, id, vec)``: each run's pick among points that carry ``d2`` (round 0: NULL, a uniform pick).

    The race key is -ln(u)/D2, u the md5 draw of (id, run, t, seed) computed
    in the JVM. A task keeps its best candidate per run only, and the per-run
    minimum over tasks is a partial aggregate.
    """
    def best(batches):
        top: dict[int, tuple] = {}
        for b in batches:
            if not b.num_rows:
                continue
            ids, us = b.column(id_col).to_numpy(), _vectors(b.column("us"))
            d2 = _vectors(b.column("d2")) if b.column("d2").null_count == 0 else None
            for r in range(runs):
                u = us[:, r]
                if d2 is None:
                    key = u
                else:
                    with np.errstate(divide="ignore"):
                        key = np.where(d2[:, r] > 0, -np.log(u) / np.where(d2[:, r] > 0, d2[:, r], 1.0), np.inf)
                i = int(np.lexsort((ids, u, key))[0])
                cand = (float(key[i]), float(u[i]), int(ids[i]))
                if r not in top or cand < top[r][:3]:
                    top[r] = (*cand, b.column(vec_col)[i].as_py())
        if top:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(top), pa.int32()), *(pa.array([v[k] for v in top.values()], kind) for k, kind in
                                                    enumerate((pa.float64(), pa.float64(), pa.int64(), pa.list_(pa.float64()))))],
                ["run", "key", "u", "id", "vec"])

    # the draws are md5 hashes computed in the JVM, one per run, same as hash_uniform
    us = F.transform(F.sequence(F.lit(0), F.lit(runs - 1)),
                     lambda r: hash_uniform(F.col(id_col), r, F.lit(t), F.lit(seed)))
    cands = points.select(id_col, vec_col, "d2", us.alias("us")).mapInArrow(best, _SEED_SCHEMA)
    return (cands.groupBy("run")
            .agg(F.min_by(F.struct("id", "vec"), F.struct("key", "u", "id")).alias("pick"))
            .select("run", F.col("pick.id").alias("id"), F.col("pick.vec").alias("vec")))


def _lowered(points: DataFrame, newest: list, id_col: str, vec_col: str, counted=None) -> DataFrame:
    """The points with ``d2`` lowered to the distance to each run's newest centre where that is nearer."""
    cs = np.asarray(newest, dtype="float64")   # R x dim
    schema = T.StructType([points.schema[id_col], points.schema[vec_col], T.StructField("d2", T.ArrayType(T.DoubleType()))])

    def lower(batches):
        for b in batches:
            if not b.num_rows:
                continue
            d2 = _sq_dists(_vectors(b.column(vec_col)), cs)
            if counted is not None:
                counted.add(d2.size)
            if b.column("d2").null_count == 0:
                d2 = np.minimum(d2, _vectors(b.column("d2")))
            yield pa.RecordBatch.from_arrays([b.column(id_col), b.column(vec_col), _lists(d2)], [id_col, vec_col, "d2"])

    return points.select(id_col, vec_col, "d2").mapInArrow(lower, schema)


def seed_round(points: DataFrame, chosen: list | None, runs: int, t: int, seed: int,
               id_col: str = "id", vec_col: str = "vec") -> DataFrame:
    """Round t (0-based) of the seeding from scratch: ``(run, id, vec)`` of each run's pick given the chosen centres."""
    pts = points.select(id_col, F.col(vec_col).cast("array<double>").alias(vec_col), F.lit(None).cast("array<double>").alias("d2"))
    for s in range(t):
        pts = _lowered(pts, [c[s] for c in chosen], id_col, vec_col)
    return _race(pts, runs, t, seed, id_col, vec_col)


def seed_round_expr(points: DataFrame, chosen: list | None, runs: int, t: int, seed: int,
                    id_col: str = "id", vec_col: str = "vec") -> DataFrame:
    """The same round written with built-in expressions only (reference form).

    Gives the same picks as ``seed_round``; slower, because Spark evaluates
    the array lambdas row by row without generated code.
    """
    if t == 0 or not chosen:
        per_point = points.select(id_col, vec_col, F.sequence(F.lit(0), F.lit(runs - 1)).alias("runs"))
        exploded = per_point.select(id_col, vec_col, F.explode("runs").alias("run"), F.lit(1.0).alias("d2"))
    else:
        per_point = points.select(id_col, vec_col, _min_d2(F.col(vec_col), centres_literal(chosen)).alias("d2s"))
        exploded = per_point.select(id_col, vec_col, F.posexplode("d2s").alias("run", "d2"))
    u = hash_uniform(F.col(id_col), F.col("run"), F.lit(t), F.lit(seed))
    if t == 0 or not chosen:
        key = u
    else:
        key = F.when(F.col("d2") > 0, -F.log(u) / F.col("d2")).otherwise(F.lit(float("inf")))
    scored = exploded.select("run", id_col, vec_col, key.alias("key"), u.alias("u"))
    return (scored.groupBy("run")
            .agg(F.min_by(F.struct(F.col(id_col).alias("id"), F.col(vec_col).alias("vec")),
                          F.struct("key", "u", id_col)).alias("pick"))
            .select("run", F.col("pick.id").alias("id"), F.col("pick.vec").alias("vec")))


def kmeanspp_seed(points: DataFrame, k: int, runs: int, seed: int,
                  id_col: str = "id", vec_col: str = "vec", counted=None) -> tuple[list, list]:
    """K rounds, one small job each; returns (centres[run][j], picked ids[run][j]).

    The points and their running minimum distances stay persisted between
    rounds (the older copy is dropped when the newer one exists). ``counted``
    may be an accumulator of the distances computed.
    """
    chosen: list = [[] for _ in range(runs)]
    ids: list = [[] for _ in range(runs)]
    state = points.select(id_col, F.col(vec_col).cast("array<double>").alias(vec_col),
                          F.lit(None).cast("array<double>").alias("d2")).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        for t in range(k):
            older = None
            if t:
                older, state = state, _lowered(state, [c[-1] for c in chosen], id_col, vec_col, counted).persist(StorageLevel.MEMORY_AND_DISK)
            try:
                rows = _race(state, runs, t, seed, id_col, vec_col).collect()   # one row per run
            finally:
                if older is not None:
                    older.unpersist()
            for row in rows:
                chosen[row.run].append([float(x) for x in row.vec])
                ids[row.run].append(row.id)
    finally:
        state.unpersist()
    return chosen, ids


def seeds_frame(spark: SparkSession, ids: list, centres: list) -> DataFrame:
    rows = [(r, j, ids[r][j], centres[r][j]) for r in range(len(ids)) for j in range(len(ids[r]))]
    return local_frame(spark, rows, "run int, j int, id long, center array<double>")


def assign(points: DataFrame, centres: list, vec_col: str = "vec") -> DataFrame:
    """Adds ``nearest ARRAY<STRUCT<d2, j>>`` (one per run)."""
    return points.withColumn("nearest", _nearest(F.col(vec_col), centres_literal(centres)))


def center_update(assigned: DataFrame, dim: int, vec_col: str = "vec") -> DataFrame:
    """``(run, j, n, center)`` from points carrying ``nearest`` (expression form)."""
    e = assigned.select(F.posexplode("nearest").alias("run", "near"), vec_col)
    sums = [F.sum(F.col(vec_col)[d]).alias(f"s{d}") for d in range(dim)]
    agg = e.groupBy("run", F.col("near.j").alias("j")).agg(F.count(F.lit(1)).alias("n"), *sums)
    return agg.select("run", "j", "n", F.array(*[F.col(f"s{d}") / F.col("n") for d in range(dim)]).alias("center"))


_PARTIAL = T.StructType([T.StructField("run", T.IntegerType()), T.StructField("j", T.IntegerType()),
                         T.StructField("d", T.IntegerType()), T.StructField("n", T.LongType()),
                         T.StructField("s", T.DoubleType())])


def lloyd_sums(points: DataFrame, centres: list, vec_col: str = "vec") -> DataFrame:
    """Per (run, centre, dimension): points assigned and their coordinate sum.

    Each task assigns its points to the nearest centre of every run with
    numpy on Arrow batches (squared distances from differences, lowest index
    on ties), sums them with one one-hot matrix product per batch, and emits
    only per-(run, centre, dimension) partial sums, so the shuffle carries
    R x K x dim rows per task whatever the number of points.
    """
    cs = np.asarray(centres, dtype="float64")          # R x K x dim
    runs, k, dim = cs.shape

    def partials(batches):
        flat = cs.reshape(runs * k, dim)
        cnt = np.zeros((runs, k), dtype="int64")
        sums = np.zeros((runs, k, dim))
        for pdf in batches:
            if len(pdf) == 0:
                continue
            x = np.stack([np.asarray(v, dtype="float64") for v in pdf[vec_col]])
            lab = _sq_dists(x, flat).reshape(len(x), runs, k).argmin(axis=2)   # n x R, lowest j on ties
            # one-hot (n x R*K) of the chosen centre of every run: one BLAS product gives all sums
            onehot = np.zeros((len(x), runs * k))
            onehot[np.arange(len(x))[:, None], np.arange(runs)[None, :] * k + lab] = 1.0
            cnt += onehot.sum(axis=0).astype("int64").reshape(runs, k)
            sums += (onehot.T @ x).reshape(runs, k, dim)
        rr, jj = np.nonzero(cnt)
        if len(rr):
            dd = np.arange(dim)
            yield pd.DataFrame({"run": np.repeat(rr, dim).astype("int32"), "j": np.repeat(jj, dim).astype("int32"),
                                "d": np.tile(dd, len(rr)).astype("int32"),
                                "n": np.repeat(cnt[rr, jj], dim), "s": sums[rr, jj].ravel()})

    p = points.select(vec_col).mapInPandas(partials, _PARTIAL)
    return p.groupBy("run", "j", "d").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))


def lloyd_step(points: DataFrame, centres: list, vec_col: str = "vec") -> DataFrame:
    """One Lloyd step for all runs: ``(run, j, n, center)`` (see ``lloyd_sums``)."""
    agg = lloyd_sums(points, centres, vec_col)
    return (agg.groupBy("run", "j")
            .agg(F.max("n").alias("n"), F.sort_array(F.collect_list(F.struct("d", (F.col("s") / F.col("n")).alias("m")))).alias("dm"))
            .select("run", "j", "n", F.transform("dm", lambda e: e["m"]).alias("center")))


def _collect_centres(sums: DataFrame, old: list) -> list:
    return _moved_centres(sums.collect(), old)   # R x K x dim rows at most: fixed by the parameters


def _moved_centres(rows: list, old: list) -> list:
    new = [[list(c) for c in run] for run in old]
    for row in rows:
        new[row.run][row.j][row.d] = float(row.s) / float(row.n)
    return new   # a centre that lost all its points keeps its place


def max_shift(old: list, new: list) -> float:
    """Max over runs of the summed L2 movement of the run's centres."""
    a, b = np.asarray(old), np.asarray(new)
    return float(np.max(np.sum(np.sqrt(np.sum((a - b) ** 2, axis=2)), axis=1)))


_STATE = T.StructType([T.StructField("vec", T.ArrayType(T.DoubleType())), T.StructField("label", T.ArrayType(T.IntegerType())),
                       T.StructField("upper", T.ArrayType(T.DoubleType())), T.StructField("lower", T.ArrayType(T.DoubleType())),
                       T.StructField("work", T.LongType())])
SLACK = 1e-9     # bounds nearer than this share of each other are not trusted: the distances decide
FRESH = 10       # steps after which the bounds are computed anew from the points (keeps the lineage short)


def _first_bounds(x: np.ndarray, cs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Label, distance to its centre and to the next nearest one, per point and run."""
    runs, k, dim = cs.shape
    d2 = _sq_dists(x, cs.reshape(-1, dim)).reshape(len(x), runs, k)
    label = d2.argmin(axis=2)                                     # lowest j on ties
    near = np.sqrt(np.take_along_axis(d2, label[:, :, None], 2))[:, :, 0]
    np.put_along_axis(d2, label[:, :, None], np.inf, 2)
    return label, near, np.sqrt(d2.min(axis=2))


def _next_bounds(x, label, upper, lower, cs, moved) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """The same after centres have moved by ``moved[run, j]``, and the number of distances computed.

    Hamerly's bounds: a point keeps its label where the upper bound of its
    own centre's distance is below the lower bound of the others', or below
    half the distance from its centre to the nearest other centre.
    """
    runs, k, dim = cs.shape
    rr = np.arange(runs)[None, :]
    most = np.sort(moved, axis=1)
    furthest = np.where(moved == most[:, -1:], most[:, -2:-1] if k > 1 else 0.0, most[:, -1:])   # of the other centres
    upper = upper + moved[rr, label]
    lower = lower - furthest[rr, label]
    gap = np.sqrt(((cs[:, :, None, :] - cs[:, None, :, :]) ** 2).sum(3))
    gap[:, np.arange(k), np.arange(k)] = np.inf
    apart = np.maximum(lower, gap.min(2)[rr, label] / 2)
    p, r = np.nonzero(upper * (1 + SLACK) >= apart * (1 - SLACK))
    work = len(p)
    for lo in range(0, len(p), CHUNK * 64):                       # first the distance to the own centre
        i, q = p[lo:lo + CHUNK * 64], r[lo:lo + CHUNK * 64]
        upper[i, q] = np.sqrt(((x[i] - cs[q, label[i, q]]) ** 2).sum(1))
    still = upper[p, r] * (1 + SLACK) >= apart[p, r] * (1 - SLACK)
    p, r = p[still], r[still]
    work += len(p) * k
    for lo in range(0, len(p), CHUNK * 8):
        i, q = p[lo:lo + CHUNK * 8], r[lo:lo + CHUNK * 8]
        d = x[i][:, None, :] - cs[q]
        d2 = np.einsum("ijk,ijk->ij", d, d)
        label[i, q] = d2.argmin(1)
        upper[i, q] = np.sqrt(d2.min(1))
        d2[np.arange(len(i)), label[i, q]] = np.inf
        lower[i, q] = np.sqrt(d2.min(1))
    return label, upper, lower, work


def _bounded_state(source: DataFrame, centres: list, moved: np.ndarray | None, vec_col: str) -> DataFrame:
    """Points with their labels and bounds under these centres, from scratch or from the last state."""
    cs = np.asarray(centres, dtype="float64")

    def run(batches):
        for b in batches:
            if not b.num_rows:
                continue
            x = _vectors(b.column(vec_col))
            if moved is None:
                label, upper, lower = _first_bounds(x, cs)
                work = x.shape[0] * cs.shape[0] * cs.shape[1]
            else:
                label, upper, lower, work = _next_bounds(x, _vectors(b.column("label")).astype("int64"), _vectors(b.column("upper")),
                                                         _vectors(b.column("lower")), cs, moved)
            share = np.zeros(len(x), dtype="int64")
            share[0] = work
            yield pa.RecordBatch.from_arrays([b.column(vec_col), _lists(label.astype("int32")), _lists(upper), _lists(lower), pa.array(share)],
                                             _STATE.fieldNames())

    cols = [vec_col] if moved is None else _STATE.fieldNames()
    return source.select(*cols).mapInArrow(run, _STATE)


def _label_sums(state: DataFrame, runs: int, k: int, dim: int) -> DataFrame:
    """Per (run, centre, dimension) the points labelled so and their coordinate sum; run -1 holds the distances computed."""
    def partials(batches):
        cnt, sums, work = np.zeros((runs, k), dtype="int64"), np.zeros((runs, k, dim)), 0
        for b in batches:
            if not b.num_rows:
                continue
            x, lab = _vectors(b.column("vec")), _vectors(b.column("label")).astype("int64")
            work += int(b.column("work").to_numpy().sum())
            onehot = np.zeros((len(x), runs * k))
            onehot[np.arange(len(x))[:, None], np.arange(runs)[None, :] * k + lab] = 1.0
            cnt += onehot.sum(axis=0).astype("int64").reshape(runs, k)
            sums += (onehot.T @ x).reshape(runs, k, dim)
        rr, jj = np.nonzero(cnt)
        if len(rr):
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.append(np.repeat(rr, dim), -1).astype("int32")), pa.array(np.append(np.repeat(jj, dim), -1).astype("int32")),
                 pa.array(np.append(np.tile(np.arange(dim), len(rr)), -1).astype("int32")),
                 pa.array(np.append(np.repeat(cnt[rr, jj], dim), work)), pa.array(np.append(sums[rr, jj].ravel(), 0.0))],
                _PARTIAL.fieldNames())

    p = state.select("vec", "label", "work").mapInArrow(partials, _PARTIAL)
    return p.groupBy("run", "j", "d").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))


def kmeans_multi(points: DataFrame, k: int, runs: int, seed: int, converge_dist: float = 0.1,
                 max_iter: int = 100, id_col: str = "id", vec_col: str = "vec") -> dict:
    """Seed, then Lloyd steps for all runs until the max shift is <= converge_dist.

    At least one step is always made. Returns centres, iterations, shifts,
    ``distances`` (computed in each step; a plain step takes points x runs x
    k) and ``converged``: False if ``max_iter`` ended the loop.
    """
    pts = points.select(id_col, F.col(vec_col).cast("array<double>").alias("vec"))
    with persisted(pts) as pts:
        dim = len(pts.select("vec").first()[0])
        centres, ids = kmeanspp_seed(pts, k, runs, seed, id_col, "vec")
        shifts, distances = [], []
        state, moved = None, None
        try:
            for step in range(max_iter):
                source = pts if step % FRESH == 0 else state
                new_state = _bounded_state(source, centres, None if source is pts else moved, "vec").persist(StorageLevel.MEMORY_AND_DISK)
                rows = _label_sums(new_state, runs, k, dim).collect()   # R x K x dim rows at most: fixed by the parameters
                if state is not None:
                    state.unpersist()
                state = new_state
                distances.append(sum(r.n for r in rows if r.run < 0))
                new = _moved_centres([r for r in rows if r.run >= 0], centres)
                moved = np.sqrt(((np.asarray(new) - np.asarray(centres)) ** 2).sum(2))
                shifts.append(max_shift(centres, new))
                centres = new
                if shifts[-1] <= converge_dist:
                    break
        finally:
            if state is not None:
                state.unpersist()
        return {"centres": centres, "seed_ids": ids, "iterations": len(shifts), "shifts": shifts, "dim": dim, "distances": distances,
                "converged": bool(shifts) and shifts[-1] <= converge_dist}


def centres_frame(spark: SparkSession, centres: list) -> DataFrame:
    rows = [(r, j, c) for r, run in enumerate(centres) for j, c in enumerate(run)]
    return local_frame(spark, rows, "run int, j int, center array<double>")


def kmeans_assign(points: DataFrame, centres: list, id_col: str = "id", vec_col: str = "vec") -> DataFrame:
    """``(id, labels ARRAY<INT>, d2 ARRAY<DOUBLE>)``: nearest centre per run, lowest index on ties."""
    cs = np.asarray(centres, dtype="float64")
    runs, k, dim = cs.shape
    pts = points.select(id_col, F.col(vec_col).cast("array<double>").alias(vec_col))

    def run(batches):
        for b in batches:
            if not b.num_rows:
                continue
            d2 = _sq_dists(_vectors(b.column(vec_col)), cs.reshape(-1, dim)).reshape(-1, runs, k)
            yield pa.RecordBatch.from_arrays([b.column(id_col), _lists(d2.argmin(2).astype("int32")), _lists(d2.min(2))],
                                             [id_col, "labels", "d2"])

    return pts.mapInArrow(run, T.StructType([pts.schema[id_col], T.StructField("labels", T.ArrayType(T.IntegerType())),
                                             T.StructField("d2", T.ArrayType(T.DoubleType()))]))


def run_cost(labels: DataFrame) -> DataFrame:
    """``(run, cost)``: summed squared distance to the nearest centre."""
    e = labels.select(F.posexplode("d2").alias("run", "d2"))
    return e.groupBy("run").agg(F.sum("d2").alias("cost"))


def cost_summary(costs: DataFrame) -> DataFrame:
    return costs.agg(F.log2(F.max("cost")).alias("log2_max"), F.log2(F.min("cost")).alias("log2_min"),
                     F.log2(F.avg("cost")).alias("log2_mean"), F.min_by("run", F.struct("cost", "run")).alias("best_run"))


_PREFIXES = "i int, sig array<int>, c bigint, c_log_c double, n bigint"


def signature_entropy(labels: DataFrame, runs: int) -> DataFrame:
    """``(i, entropy, effective)`` for the joint label of the first i runs, i = 1..runs.

    The distinct full signatures are counted once and sorted, so the
    signatures that share their first i labels are neighbours. A task rolls
    its sorted part up from the longest prefix to the shortest and sends, per
    i, the sum of c log2 c of the groups inside it and the counts of the first
    and the last group, which may go on in other tasks.
    """
    counts = labels.groupBy(F.slice("labels", 1, runs).alias("sig")).agg(F.count(F.lit(1)).alias("c"))

    def roll_up(batches):
        parts = [b for b in batches if b.num_rows]
        if not parts:
            return
        sig = np.concatenate([_vectors(b.column("sig")) for b in parts]).astype("int32")
        c = np.concatenate([b.column("c").to_numpy() for b in parts])
        differ = sig[1:] != sig[:-1]
        first = np.concatenate([[-1], np.where(differ.any(1), differ.argmax(1), runs)])   # where a row leaves the one before
        rows, n = np.arange(len(c)), int(c.sum())
        out: list[tuple] = []
        for i in range(runs, 0, -1):
            begin = np.flatnonzero(first[rows] < i)
            c, rows = np.add.reduceat(c, begin), rows[begin]
            inner = c[1:-1].astype("float64")
            out.append((i, None, 0, float((inner * np.log2(inner)).sum()), n))
            out += [(i, sig[rows[at], :i].tolist(), int(c[at]), 0.0, 0) for at in {0, len(c) - 1}]
        yield pa.RecordBatch.from_arrays([pa.array(x, kind) for x, kind in zip(
            zip(*out, strict=True), (pa.int32(), pa.list_(pa.int32()), pa.int64(), pa.float64(), pa.int64()), strict=True)],
            ["i", "sig", "c", "c_log_c", "n"])

    parts = counts.repartitionByRange("sig").sortWithinPartitions("sig").mapInArrow(roll_up, _PREFIXES)
    groups = parts.groupBy("i", "sig").agg(*[F.sum(x).alias(x) for x in ("c", "c_log_c", "n")])
    total = F.sum("c_log_c") + F.sum(F.when(F.col("c") > 0, F.col("c") * F.log2("c")).otherwise(0.0))
    h = groups.groupBy("i").agg((F.log2(F.sum("n")) - total / F.sum("n")).alias("entropy"))
    return h.select("i", "entropy", F.pow(F.lit(2.0), F.col("entropy")).alias("effective"))


def kmeans_best(spark: SparkSession, centres: list, costs: DataFrame) -> DataFrame:
    best = costs.agg(F.min_by("run", F.struct("cost", "run")).alias("run"))
    return centres_frame(spark, centres).join(best, "run", "left_semi")


def potential(points: DataFrame, centres: list, id_col: str = "id", vec_col: str = "vec") -> DataFrame:
    """``(run, potential)``: sum over points of D^2 to the run's centres."""
    return run_cost(kmeans_assign(points, centres, id_col, vec_col)).withColumnRenamed("cost", "potential")
