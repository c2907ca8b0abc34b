"""Ordinary least squares from one pass of mergeable centred moments.

Every task keeps, per split, the row count, the mean of each column and the
centred co-moments of all pairs of columns, updated batch by batch; the
tasks' moments are merged pairwise by the same formula. Nothing is ever
subtracted from a large uncentred sum, so R^2 keeps its digits however far
the columns lie from zero. The moments have a fixed size, so fitting every
target, scoring train and test and refitting with each input left out are
small solves on the driver with no further pass over the data.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.session import local_frame

MERGERS = 16     # tasks that merge the others' moments before the driver merges theirs
_MOMENTS = "split string, n bigint, mean array<double>, co array<double>"


def gram_aggregates(df: DataFrame, inputs: list[str], targets: list[str], split_col: str = "split") -> DataFrame:
    """One row per split with every Gram sum as a column (``xx_i_j``, ``xy_i_t``, ``yy_t``).

    Column 0 of X is the intercept (1.0), so ``xx_0_0`` is the row count.
    Rows with a NULL input or target are left out.
    """
    xs = [F.lit(1.0)] + [F.col(c).cast("double") for c in inputs]
    ys = [F.col(c).cast("double") for c in targets]
    aggs = []
    for i in range(len(xs)):
        for j in range(i, len(xs)):
            aggs.append(F.sum(xs[i] * xs[j]).alias(f"xx_{i}_{j}"))
        for t in range(len(ys)):
            aggs.append(F.sum(xs[i] * ys[t]).alias(f"xy_{i}_{t}"))
    for t in range(len(ys)):
        aggs.append(F.sum(ys[t] * ys[t]).alias(f"yy_{t}"))
    cols = inputs + targets
    clean = df.where(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in cols]))
    return clean.groupBy(split_col).agg(*aggs)


def merged(a: tuple, b: tuple) -> tuple:
    """The moments (n, means, co-moments) of two sets of rows together."""
    (n, x, c), (m, y, d) = a, b
    if not n or not m:
        return b if not n else a
    step = y - x
    return n + m, x + step * (m / (n + m)), c + d + np.outer(step, step) * (n * m / (n + m))


def moments_of(rows: np.ndarray) -> tuple:
    """The moments of a matrix of rows, taken about its first row and then corrected to the mean."""
    if not len(rows):
        return 0, np.zeros(rows.shape[1]), np.zeros((rows.shape[1],) * 2)
    d = rows - rows[0]
    mean = d.mean(0)
    d -= mean
    rest = d.mean(0)        # what rounding left in the mean
    return len(rows), rows[0] + (mean + rest), d.T @ d - len(rows) * np.outer(rest, rest)


def _batch_of(found: dict[str, tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(list(found), pa.string()), pa.array([m[0] for m in found.values()], pa.int64()),
         pa.array([m[1].tolist() for m in found.values()], pa.list_(pa.float64())),
         pa.array([m[2].ravel().tolist() for m in found.values()], pa.list_(pa.float64()))], ["split", "n", "mean", "co"])


def _rows_merged(rows, found: dict[str, tuple]) -> dict[str, tuple]:
    for split, n, mean, co in rows:
        one = (n, np.array(mean), np.array(co).reshape(len(mean), len(mean)))
        found[split] = merged(found[split], one) if split in found else one
    return found


def moments(df: DataFrame, cols: list[str], split_col: str = "split") -> dict[str, tuple]:
    """``{split: (n, means, co-moments)}`` of the columns; rows with a NULL in any of them are left out."""
    kept = [F.col(c).cast("double") for c in cols]
    clean = df.where(reduce(lambda a, b: a & b, [c.isNotNull() for c in kept]))

    def by_task(batches):
        found: dict[str, tuple] = {}
        for b in batches:
            x = np.column_stack([b.column(f"v{i}").to_numpy() for i in range(len(cols))])
            split = b.column("split").dictionary_encode()
            codes = split.indices.to_numpy(zero_copy_only=False)
            for k, name in enumerate(split.dictionary.to_pylist()):
                one = moments_of(x[codes == k])
                found[name] = merged(found[name], one) if name in found else one
        if found:
            yield _batch_of(found)

    def again(batches):
        found: dict[str, tuple] = {}
        for b in batches:
            _rows_merged(zip(*(b.column(c).to_pylist() for c in ("split", "n", "mean", "co")), strict=True), found)
        if found:
            yield _batch_of(found)

    parts = clean.select(F.col(split_col).cast("string").alias("split"), *[c.alias(f"v{i}") for i, c in enumerate(kept)]) \
        .where(F.col("split").isNotNull()).mapInArrow(by_task, _MOMENTS)
    rows = parts.repartition(MERGERS).mapInArrow(again, _MOMENTS).collect()    # MERGERS rows a split at most
    return _rows_merged([(r.split, r.n, r["mean"], r.co) for r in rows], {})


def _solve(sxx: np.ndarray, sxy: np.ndarray) -> np.ndarray:
    """Slopes from centred co-moments; columns are scaled first, a constant column gets 0."""
    scale = np.sqrt(np.diag(sxx))
    scale = np.where(scale > 0, scale, 1.0)
    return np.linalg.lstsq(sxx / np.outer(scale, scale), sxy / scale, rcond=None)[0] / scale


def _r2(m: tuple | None, slopes: np.ndarray, keep: list[int], y: int, centre: float) -> float:
    """1 - SSE / SST on a split; ``centre`` is the intercept of the fit."""
    if m is None or not m[0]:
        return float("nan")
    n, mean, co = m
    off = mean[y] - centre - mean[keep] @ slopes          # mean residual
    sse = co[y, y] - 2.0 * slopes @ co[keep, y] + slopes @ co[np.ix_(keep, keep)] @ slopes + n * off * off
    return float(1.0 - sse / co[y, y]) if co[y, y] > 0 else float("nan")


def fit_all(found: dict, inputs: list[str], targets: list[str], train: str = "train",
            test: str = "test") -> tuple[list, list, list]:
    """Coefficients, R^2 and ablation rows for every target."""
    n, mean, co = found[train]
    held = found.get(test)
    p = len(inputs)

    def fit(keep, y):
        slopes = _solve(co[np.ix_(keep, keep)], co[keep, y])
        centre = mean[y] - mean[keep] @ slopes
        return slopes, centre, _r2(found[train], slopes, keep, y, centre), _r2(held, slopes, keep, y, centre)

    coef_rows, score_rows, abl_rows = [], [], []
    full = list(range(p))
    for t, name in enumerate(targets):
        slopes, centre, r2_train, r2_test = fit(full, p + t)
        coef_rows.append((name, "intercept", float(centre)))
        coef_rows += [(name, x, float(b)) for x, b in zip(inputs, slopes, strict=True)]
        score_rows.append((name, r2_train, r2_test))
        for k, x in enumerate(inputs):
            _, _, without_train, without_test = fit([i for i in full if i != k], p + t)
            abl_rows.append((name, x, r2_train - without_train, r2_test - without_test))
    return coef_rows, score_rows, abl_rows


def linreg(spark: SparkSession, df: DataFrame, inputs: list[str], targets: list[str],
           split_col: str = "split") -> dict[str, DataFrame]:
    """Fit, score and ablate; returns ``coefficients``, ``scores``, ``ablation`` frames."""
    coefs, scores, abl = fit_all(moments(df, inputs + targets, split_col), inputs, targets)
    return {
        "coefficients": local_frame(spark, coefs, "target string, feature string, coef double"),
        "scores": local_frame(spark, scores, "target string, r2_train double, r2_test double"),
        "ablation": local_frame(spark, abl, "target string, removed string, drop_train double, drop_test double"),
    }
