"""Statistics, principal components and reconstructions of slot series.

A series is ``(station, measurement, year, values ARRAY<DOUBLE>)`` with one
element per slot (365 days in the reference); a missing value is a NULL
element. Everything is grouped by measurement so that all measurements are
handled by one job.

Scale notes
- Per-slot and per-measurement statistics are hash aggregates with partial
  aggregation, so a measurement holding a third of the rows is pre-reduced
  in every task before the shuffle.
- The pairwise-complete covariance is built from per-partition partial sums
  (one slots x slots block per measurement per partition, computed with
  numpy matrix products in ``mapInPandas``) and summed by (measurement, i, j);
  no pairs of rows or slots are emitted per series.
- Tables with a row per measurement (limits, means with their vectors) are
  read by the driver and sent to the series as checked broadcasts, so no
  series is dealt out by measurement, of which there are few.
- The eigen-decomposition runs per measurement in ``applyInPandas`` on the
  slots x slots covariance rows, a group whose size is fixed by the number of
  slots and does not grow with the data.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.functions.vectors import nan_to_null
from quarry.operators.joins import bounded_broadcast
from quarry.session import local_frame

SERIES_KEYS = ["station", "measurement", "year"]
# Leading bits of a value's key counted at each level of the exact ranks, and
# the size of a cell from which on the rest is counted at once. They decide
# how many counts a task holds, never the result.
KEY_BITS = (24, 20, 20)
SMALL_CELL = 1 << 20
MAX_MEASUREMENTS = 100_000   # rows of a table by measurement that are broadcast
#: Percentiles in thousandths, so that ranks are exact integers.
PERMILLE = {"low1000": 1, "low100": 10, "high100": 990, "high1000": 999}


# ---------------------------------------------------------------------------
# shape
# ---------------------------------------------------------------------------

def flatten_series(nested: DataFrame) -> DataFrame:
    """``station, years ARRAY<STRUCT<measurement, year, values>>`` -> flat rows."""
    e = nested.select("station", F.explode("years").alias("y"))
    return e.select("station", F.col("y.measurement").alias("measurement"),
                    F.col("y.year").alias("year"), nan_to_null(F.col("y.values")).alias("values"))


def valid_length(series: DataFrame, slots: int) -> DataFrame:
    """Per measurement: series with exactly ``slots`` elements and the others."""
    ok = F.size("values") == slots
    return series.groupBy("measurement").agg(
        F.sum(ok.cast("int")).alias("n_valid"), F.sum((~ok).cast("int")).alias("n_invalid"))


def require_length(series: DataFrame, slots: int) -> DataFrame:
    """Fail the job on a series of the wrong length (the reference raises)."""
    return series.where(F.assert_true(F.size("values") == slots).isNull())


def slot_values(series: DataFrame, keep_missing: bool = False) -> DataFrame:
    """``(keys..., slot, value)``, slot 0-based; missing values dropped unless asked."""
    keys = [c for c in series.columns if c != "values"]
    out = series.select(*keys, F.posexplode("values").alias("slot", "value"))
    return out if keep_missing else out.where(F.col("value").isNotNull() & ~F.isnan("value"))


# ---------------------------------------------------------------------------
# statistics
# ---------------------------------------------------------------------------

def slot_stats(series: DataFrame) -> DataFrame:
    """``(measurement, slot, ne, mean, var)``: count, mean, population variance."""
    v = slot_values(series)
    return v.groupBy("measurement", "slot").agg(
        F.count("value").alias("ne"), F.avg("value").alias("mean"), F.var_pop("value").alias("var"))


def slot_mean_band(stats: DataFrame) -> DataFrame:
    """Mean and mean +- standard deviation per slot."""
    sd = F.sqrt("var")
    return stats.select("measurement", "slot", "mean", sd.alias("std"),
                        (F.col("mean") - sd).alias("lower"), (F.col("mean") + sd).alias("upper"))


def ordered_keys(values: np.ndarray) -> np.ndarray:
    """64-bit keys in the order of the doubles."""
    bits = (values + 0.0).view(np.int64)        # -0.0 and 0.0 are one value
    return np.where(bits < 0, ~bits, bits | np.int64(-1 << 63)).view(np.uint64)


def value_of_key(key: int) -> float:
    bits = key ^ (1 << 63) if key >> 63 else key ^ ((1 << 64) - 1)
    return float(np.array([bits], np.uint64).view(np.float64)[0])


_CELLS = "measurement string, prefix bigint, cell bigint, cnt bigint"


def _cell_counts(series: DataFrame, known: int, bits: int) -> DataFrame:
    """``(measurement, prefix, cell, cnt)``: values by the ``bits`` of their key behind the first ``known`` ones.

    With ``known`` bits only values whose leading bits are in the column
    ``prefixes`` count. Tasks count on Arrow batches, the counts are partially
    aggregated before they move.
    """
    def count(batches):
        for b in batches:
            values = b.column("values")
            lens = pc.fill_null(values.value_lengths(), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            flat = values.flatten().to_numpy(zero_copy_only=False).astype("float64")
            names = b.column("measurement").dictionary_encode()
            codes = pc.fill_null(names.indices, len(names.dictionary)).to_numpy(zero_copy_only=False).astype(np.int64)
            own = np.repeat(codes, lens)[~np.isnan(flat)]
            key = ordered_keys(flat[~np.isnan(flat)])
            found = []
            for code in np.unique(own).tolist():
                k = key[own == code]
                for prefix in (b.column("prefixes")[int(np.argmax(codes == code))].as_py() if known else [0]):
                    part = k[(k >> np.uint64(64 - known)) == np.uint64(prefix)] if known else k
                    cell, n = np.unique((part << np.uint64(known)) >> np.uint64(64 - bits), return_counts=True)
                    found.append((names.dictionary[code].as_py() if code < len(names.dictionary) else None, prefix, cell, n))
            for name, prefix, cell, n in found:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * len(cell), pa.string()), pa.array([prefix] * len(cell), pa.int64()),
                     pa.array(cell.astype(np.int64)), pa.array(n)], ["measurement", "prefix", "cell", "cnt"])

    cols = ["measurement", "values"] + (["prefixes"] if known else [])
    return series.select(*cols).mapInArrow(count, _CELLS).groupBy("measurement", "prefix", "cell").agg(F.sum("cnt").alias("cnt"))


def _exact_ranks(series: DataFrame, bits: tuple[int, ...], small: int) -> dict:
    """``{measurement: {name: value}}`` of the percentiles.

    Each level counts the values by the next bits of their ordered keys and
    keeps, per rank, the cell that holds it: at most one cell per measurement
    and percentile comes to the driver.
    """
    spark = series.sparkSession
    ranks = F.explode(F.array(*[
        F.struct(F.lit(name).alias("name"), F.greatest(F.lit(1), F.expr(f"(n * {p} + 999) div 1000")).alias("rank"))
        for name, p in PERMILLE.items()])).alias("r")
    known, found, todo = 0, {}, list(bits)
    picks = None
    while todo:
        now = todo.pop(0)
        if known and max(p.cnt for p in picks) <= small:
            now, todo = 64 - known, []
        of = Window.partitionBy("measurement", "prefix")
        if known:
            by_name: dict = {}
            for p in picks:
                by_name.setdefault(p.measurement, []).append((p.name, found[p.measurement][p.name], p.rank))
            wanted = local_frame(spark, [(m, sorted({x[1] for x in own})) for m, own in by_name.items()], "of string, prefixes array<bigint>")
            wanted = bounded_broadcast(wanted, MAX_MEASUREMENTS)
            at = local_frame(spark, [(m, q, name, rank) for m, own in by_name.items() for name, q, rank in own],
                             "of string, at bigint, name string, rank bigint")
            cells = _cell_counts(series.join(wanted, F.col("measurement").eqNullSafe(F.col("of"))), known, now)
            cells = cells.withColumn("upto", F.sum("cnt").over(of.orderBy("cell"))).join(
                bounded_broadcast(at, MAX_MEASUREMENTS * len(PERMILLE)), F.col("measurement").eqNullSafe(F.col("of")) & (F.col("prefix") == F.col("at")))
            rank = F.col("rank")
        else:
            cells = _cell_counts(series, 0, now)
            cells = (cells.withColumn("upto", F.sum("cnt").over(of.orderBy("cell"))).withColumn("n", F.sum("cnt").over(of))
                     .select("measurement", "cell", "cnt", "upto", ranks).withColumn("name", F.col("r.name")))
            rank = F.col("r.rank")
        picks = (cells.where((rank <= F.col("upto")) & (rank > F.col("upto") - F.col("cnt")))
                 .select("measurement", "name", "cell", "cnt", (rank - F.col("upto") + F.col("cnt")).alias("rank")).collect())
        if not picks:
            return {}
        for p in picks:
            own = found.setdefault(p.measurement, {})
            own[p.name] = (own.get(p.name, 0) << now) | p.cell
        known += now
    return {m: {name: value_of_key(key) for name, key in own.items()} for m, own in found.items()}


def scalar_stats(series: DataFrame, bits: tuple[int, ...] = KEY_BITS, small: int = SMALL_CELL) -> DataFrame:
    """``(measurement, mean, std, low1000, low100, high100, high1000)``, one row per measurement, known to the driver.

    low/high 100 are the 1st/99th and low/high 1000 the 0.1th/99.9th
    percentiles: the value of rank ceil(p * n), exactly, for any n. The
    values are read once for mean and deviation, once by the leading bits of
    their ordered keys, and once (or, in very full cells, twice) for the rest
    of the bits in the cells that hold a rank.
    """
    v = slot_values(series)
    totals = v.groupBy("measurement").agg(F.avg("value").alias("mean"), F.stddev_pop("value").alias("std")).collect()
    found = _exact_ranks(series, bits, small) if totals else {}
    rows = [(t.measurement, t["mean"], t["std"], *[found[t.measurement][name] for name in PERMILLE]) for t in totals]
    return local_frame(series.sparkSession, rows, "measurement string, mean double, std double, "
                       + ", ".join(f"{name} double" for name in PERMILLE))


def in_range(series: DataFrame, scalars: DataFrame) -> DataFrame:
    """Present values in [low100, high100] of their measurement, both ends kept, with the limits."""
    lims = bounded_broadcast(scalars.select("measurement", "low100", "high100"), MAX_MEASUREMENTS)
    v = slot_values(series).join(lims, "measurement")
    return v.where(F.col("value").between(F.col("low100"), F.col("high100")))


def value_histogram(series: DataFrame, scalars: DataFrame, bins: int = 100) -> DataFrame:
    """``(measurement, bin, cnt)`` of values in [low100, high100], both ends kept.

    Bin b covers [lo + b*w, lo + (b+1)*w); the upper end falls in the last bin.
    """
    v = in_range(series, scalars)
    width = F.col("high100") - F.col("low100")
    b = F.when(width > 0, F.least(F.floor((F.col("value") - F.col("low100")) / width * bins),
                                  F.lit(bins - 1))).otherwise(F.lit(0)).cast("int")
    return v.groupBy("measurement", b.alias("bin")).agg(F.count(F.lit(1)).alias("cnt"))


def uneven_stations(series: DataFrame, threshold: float) -> DataFrame:
    """Stations whose number of measurements per slot varies more than ``threshold``.

    Counts are zero-filled (every series has every slot) before the
    population variance over slots is taken, from whole-number sums, so that
    a station at the threshold is never let in by rounding.
    """
    v = slot_values(series, keep_missing=True)
    present = (F.col("value").isNotNull() & ~F.isnan("value")).cast("int")
    per_slot = v.groupBy("station", "slot").agg(F.sum(present).alias("n"))
    m, s, ss = F.count(F.lit(1)), F.sum("n"), F.sum(F.col("n") * F.col("n"))
    return (per_slot.groupBy("station").agg(((m * ss - s * s) / (m * m)).alias("count_var"))
            .where(F.col("count_var") > threshold))


# ---------------------------------------------------------------------------
# covariance with missing values and principal components
# ---------------------------------------------------------------------------

_PARTIAL_SCHEMA = T.StructType([
    T.StructField("measurement", T.StringType()), T.StructField("i", T.IntegerType()),
    T.StructField("j", T.IntegerType()), T.StructField("n", T.DoubleType()),
    T.StructField("sx", T.DoubleType()), T.StructField("sy", T.DoubleType()),
    T.StructField("sxy", T.DoubleType())])


def _gram_partials(means: dict[str, list[float]]):
    """Per partition and measurement: pairwise-complete sums over its series, less the slot means."""
    def run(batches):
        acc: dict[str, list] = {}
        for pdf in batches:
            for m, part in pdf.groupby("measurement", sort=False):
                shift = np.array(means[m])
                if (part["values"].map(len) != len(shift)).any():
                    raise ValueError(f"series of {m} differ in length; see require_length")
                x = np.array([np.array(list(v), dtype="float64") for v in part["values"]]) - shift
                present = ~np.isnan(x)
                x0 = np.where(present, x, 0.0)
                pm = present.astype("float64")
                blk = (pm.T @ pm, x0.T @ pm, x0.T @ x0)
                acc[m] = [a + b for a, b in zip(acc[m], blk)] if m in acc else list(blk)
        for m, (n, sx, sxy) in acc.items():
            # the blocks are symmetric (sy = sx transposed): send the upper triangle only
            ii, jj = np.triu_indices(n.shape[0])
            yield pd.DataFrame({"measurement": m, "i": ii.astype("int32"), "j": jj.astype("int32"),
                                "n": n[ii, jj], "sx": sx[ii, jj], "sy": sx[jj, ii], "sxy": sxy[ii, jj]})
    return run


def gram_sums(series: DataFrame) -> DataFrame:
    """``(measurement, i, j, n, sx, sy, sxy)`` for i <= j, summed over all series.

    ``n`` counts series with both slots present; ``sx``/``sy`` sum slot i/j
    over those series; ``sxy`` sums the products. All values are taken less
    their slot's mean, so large means lose no digits. The means (one number
    per measurement and slot, whatever the number of series) are read by the
    driver. Only the upper triangle is shuffled; the lower one follows by
    symmetry. Series of unequal length end the job.
    """
    means: dict[str, dict[int, float]] = {}
    slots = slot_values(series, keep_missing=True)
    value = F.when(~F.isnan("value"), F.col("value"))
    for r in slots.groupBy("measurement", "slot").agg(F.avg(value).alias("mean")).collect():
        means.setdefault(r.measurement, {})[r.slot] = 0.0 if r["mean"] is None else r["mean"]
    shifts = {m: [by_slot[k] for k in range(len(by_slot))] for m, by_slot in means.items()}
    parts = series.where(F.size("values") > 0).select("measurement", "values").mapInPandas(_gram_partials(shifts), _PARTIAL_SCHEMA)
    return parts.groupBy("measurement", "i", "j").agg(
        *[F.sum(c).alias(c) for c in ("n", "sx", "sy", "sxy")])


def covariance(series: DataFrame) -> DataFrame:
    """Pairwise-complete population covariance ``(measurement, i, j, n, cov)``, all i, j.

    NULL for a pair of slots that no series has both of.
    """
    g = gram_sums(series)
    cov = F.when(F.col("n") > 0, F.col("sxy") / F.col("n")
                 - (F.col("sx") / F.col("n")) * (F.col("sy") / F.col("n")))
    # mirror in the same pass: an off-diagonal entry yields (i, j) and (j, i)
    ij = F.struct(F.col("i").alias("i"), F.col("j").alias("j"))
    ji = F.struct(F.col("j").alias("i"), F.col("i").alias("j"))
    pairs = F.when(F.col("i") < F.col("j"), F.array(ij, ji)).otherwise(F.array(ij))
    out = g.select("measurement", F.explode(pairs).alias("p"),
                   F.col("n").cast("long").alias("n"), cov.alias("cov"))
    return out.select("measurement", F.col("p.i").alias("i"), F.col("p.j").alias("j"), "n", "cov")


_BASIS_SCHEMA = T.StructType([
    T.StructField("measurement", T.StringType()), T.StructField("k", T.IntegerType()),
    T.StructField("eigval", T.DoubleType()), T.StructField("eigvec", T.ArrayType(T.DoubleType()))])


def _eigen(pdf: pd.DataFrame) -> pd.DataFrame:
    m = pdf["measurement"].iloc[0]
    s = int(max(pdf["i"].max(), pdf["j"].max())) + 1
    c = np.zeros((s, s))
    c[pdf["i"].to_numpy(), pdf["j"].to_numpy()] = pdf["cov"].fillna(0.0).to_numpy()
    c = (c + c.T) / 2.0
    vals, vecs = np.linalg.eigh(c)
    order = np.argsort(-vals, kind="stable")
    vals, vecs = vals[order], vecs[:, order]
    # the sign of an eigenvector is arbitrary: make its largest entry positive
    idx = np.argmax(np.abs(vecs), axis=0)
    signs = np.sign(vecs[idx, np.arange(s)])
    signs[signs == 0] = 1.0
    vecs = vecs * signs
    return pd.DataFrame({"measurement": m, "k": np.arange(1, s + 1, dtype="int32"),
                         "eigval": vals, "eigvec": [vecs[:, k].tolist() for k in range(s)]})


def series_pca(series: DataFrame) -> DataFrame:
    """``(measurement, k, eigval, eigvec)``, k = 1.. by decreasing eigenvalue.

    The pairwise matrix need not be positive semi-definite; negative
    eigenvalues are reported, not hidden. A pair of slots that no series has
    both of counts as uncorrelated (covariance 0).
    """
    cov = covariance(series).select("measurement", "i", "j", "cov")
    return cov.groupBy("measurement").applyInPandas(_eigen, _BASIS_SCHEMA)


def explained_variance(basis: DataFrame, top: int = 9) -> DataFrame:
    """Share of the eigenvalue total explained by the first k vectors, k = 1..top."""
    w_all = Window.partitionBy("measurement")
    w_run = w_all.orderBy("k").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = basis.select("measurement", "k", (F.sum("eigval").over(w_run) / F.sum("eigval").over(w_all)).alias("explained"))
    return out.where(F.col("k") <= top)


def top_eigvecs(basis: DataFrame, k: int = 3) -> DataFrame:
    return basis.where(F.col("k") <= k)


# ---------------------------------------------------------------------------
# projection, reconstruction, residuals
# ---------------------------------------------------------------------------

def _model(stats: DataFrame, basis: DataFrame, k: int) -> DataFrame:
    """One row per measurement: mean vector and the top-k eigenvectors (slots x (k + 1) numbers, read by the driver)."""
    means: dict = {}
    for row in stats.select("measurement", "slot", "mean").collect():
        means.setdefault(row.measurement, []).append((row.slot, row["mean"]))
    vecs: dict = {}
    for row in basis.where(F.col("k") <= k).select("measurement", "k", "eigvec").collect():
        vecs.setdefault(row.measurement, []).append((row.k, row.eigvec))
    rows = [(m, [v for _, v in sorted(means[m])], [v for _, v in sorted(own)]) for m, own in vecs.items() if m in means]
    model = local_frame(stats.sparkSession, rows, "measurement string, mean_vec array<double>, eigvecs array<array<double>>")
    return bounded_broadcast(model, MAX_MEASUREMENTS)


def project_coeffs(series: DataFrame, stats: DataFrame, basis: DataFrame, k: int = 3) -> DataFrame:
    """Coefficients of each series on the top-k eigenvectors.

    A missing slot counts as equal to the mean (contributes 0).
    """
    m = _model(stats, basis, k)
    s = series.join(m, "measurement")
    centered = F.zip_with("values", "mean_vec", lambda x, mu: F.coalesce(x - mu, F.lit(0.0)))
    coeffs = F.transform("eigvecs", lambda v: F.aggregate(
        F.zip_with(centered, v, lambda a, b: a * b), F.lit(0.0), lambda acc, t: acc + t))
    keys = [c for c in series.columns if c != "values"]
    return s.select(*keys, "values", "mean_vec", "eigvecs", coeffs.alias("coeffs"))


def reconstruct(series: DataFrame, stats: DataFrame, basis: DataFrame, k: int = 3) -> DataFrame:
    """Rebuilt series from the mean and the first j vectors, j = 1..k.

    ``error`` is the L2 norm of (rebuild - original); it is NULL when the
    original misses any slot.
    """
    p = project_coeffs(series, stats, basis, k)
    keys = [c for c in series.columns if c != "values"]
    p = p.select(*keys, "values", "mean_vec", "eigvecs", "coeffs",
                 F.explode(F.sequence(F.lit(1), F.lit(k))).alias("j"))
    terms = F.slice(F.arrays_zip(F.col("coeffs").alias("c"), F.col("eigvecs").alias("v")), 1, F.col("j"))
    rebuilt = F.aggregate(terms, F.col("mean_vec"),
                          lambda acc, t: F.zip_with(acc, t["v"], lambda a, b: a + t["c"] * b))
    p = p.withColumn("rebuilt", rebuilt)
    err = F.sqrt(F.aggregate(F.zip_with("rebuilt", "values", lambda r, x: (r - x) * (r - x)),
                             F.lit(0.0), lambda acc, t: acc + t))
    return p.select(*keys, "j", "rebuilt", err.alias("error"))


def reconstruction_error(series: DataFrame, stats: DataFrame, basis: DataFrame, k: int = 3) -> DataFrame:
    r = reconstruct(series, stats, basis, k)
    keys = [c for c in series.columns if c != "values"]
    return r.where(F.col("j") == k).select(*keys, "error")


def drop_nan_error(errors: DataFrame) -> DataFrame:
    return errors.where(F.col("error").isNotNull() & ~F.isnan("error"))


def extreme_residuals(errors: DataFrame, n: int = 2) -> DataFrame:
    """The n lowest and n highest non-NULL errors of each measurement."""
    e = drop_nan_error(errors)
    keys = [c for c in errors.columns if c != "error"]
    lo = Window.partitionBy("measurement").orderBy(F.col("error").asc(), *[F.col(c) for c in keys])
    hi = Window.partitionBy("measurement").orderBy(F.col("error").desc(), *[F.col(c) for c in keys])
    low = e.withColumn("rnk", F.row_number().over(lo)).where(F.col("rnk") <= n).withColumn("side", F.lit("low"))
    high = e.withColumn("rnk", F.row_number().over(hi)).where(F.col("rnk") <= n).withColumn("side", F.lit("high"))
    return low.unionByName(high)
