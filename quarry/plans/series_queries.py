"""Registered queries for the series jobs (stand-in: hourly event profiles)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.operators import series as S
from quarry.session import shared_path
from quarry.sources import files as FI
from quarry.sources.standins import EVENT_SLOTS, event_cells, event_series_nested

DEC = 6
UNEVEN_THRESHOLD = 0.25
RECON_K = 3
OFF_TIE = 1e-8    # means of a few decimals often end in a 5 where they are rounded
PROJECTED = ("click", "purchase", "view")


def r(c, d=DEC):
    return F.round(c, d)


def _series(spark, sf_dir):
    return S.flatten_series(event_series_nested(spark, sf_dir))


def _valid(spark, sf_dir):
    s = _series(spark, sf_dir)
    return s.where(F.size("values") == EVENT_SLOTS)


def q_flatten_series(spark, sf_dir):
    s = _series(spark, sf_dir)
    return s.select("station", "measurement", "year", F.transform("values", lambda x: r(x)).alias("values"))


def q_valid_length(spark, sf_dir):
    return S.valid_length(_series(spark, sf_dir), EVENT_SLOTS)


def q_by_measurement(spark, sf_dir):
    return _valid(spark, sf_dir).groupBy("measurement").agg(F.count(F.lit(1)).alias("n_series"))


def q_slot_counts(spark, sf_dir):
    return S.slot_stats(_valid(spark, sf_dir)).select("measurement", "slot", "ne")


def _written(df: DataFrame, kind: str) -> str:
    """The path of a table written for a scan; removed when the application ends."""
    path = shared_path(df.sparkSession, kind)
    df.write.parquet(path)
    return path


def q_scan_series_stats(spark, sf_dir):
    """The three statistics tables, written and scanned, in one shape.

    ``slot`` rows have count, mean and variance of a slot, ``scalar`` rows mean,
    deviation and the four percentiles, a ``basis`` row the number of
    eigenvectors, the sum of the eigenvalues and the largest entry by which the
    vectors' products with each other differ from the identity.
    """
    s = _valid(spark, sf_dir)
    scalars, slots, basis = FI.read_series_stats(
        spark, _written(S.scalar_stats(s), "stats"), _written(S.slot_stats(s), "stats"), _written(S.series_pca(s), "stats"))

    def shaped(df, kind, index, *values):
        return df.select("measurement", F.lit(kind).alias("kind"), index.cast("int").alias("index"),
                         F.array(*[r(F.col(v).cast("double")) for v in values]).alias("values"))

    a, b = basis.select("measurement", "k", "eigvec"), basis.select("measurement", F.col("k").alias("l"), F.col("eigvec").alias("other"))
    product = F.aggregate(F.zip_with("eigvec", "other", lambda x, y: x * y), F.lit(0.0), lambda acc, v: acc + v)
    off = a.join(b, "measurement").groupBy("measurement").agg(
        F.max(F.abs(product - (F.col("k") == F.col("l")).cast("double"))).alias("off"))     # vectors x vectors, whatever the data
    sums = basis.groupBy("measurement").agg(F.count(F.lit(1)).alias("n"), F.sum("eigval").alias("total")).join(off, "measurement")
    return (shaped(slots, "slot", F.col("slot"), "ne", "mean", "var")
            .unionByName(shaped(scalars, "scalar", F.lit(None), "mean", "std", "low1000", "low100", "high100", "high1000"))
            .unionByName(shaped(sums, "basis", F.lit(None), "n", "total", "off")))


def q_scan_station_series(spark, sf_dir):
    """Every series of a table of nested station records, with its values."""
    s = FI.scan_station_series(spark, _written(event_series_nested(spark, sf_dir), "series"))
    return s.select("station", "measurement", "year", F.transform("values", lambda x: r(x)).alias("values"))


def q_scan_station_projections(spark, sf_dir):
    """``(name, vec)`` of a table of station projections: three measurements' coefficients in one vector."""
    s, st, b = _recon_inputs(spark, sf_dir)
    coeffs = S.project_coeffs(s, st, b, RECON_K).groupBy("station").pivot("measurement", list(PROJECTED)).agg(F.first("coeffs"))
    names = dict(zip(PROJECTED, ("TAVG_coeff", "TRANGE_coeff", "SNWD_coeff"), strict=True))
    place = event_cells(spark, sf_dir).groupBy("station").agg(     # four numbers of the station in the places of its location
        *[f("v").alias(n) for f, n in ((F.min, "latitude"), (F.max, "longitude"), (F.avg, "elevation"), (F.stddev_pop, "dist_coast"))])
    table = coeffs.select("station", *[F.col(m).alias(n) for m, n in names.items()]).join(place, "station")
    scanned = FI.scan_station_projections(spark, _written(table, "projections"))
    return scanned.select("name", F.transform("vec", lambda x: r(x)).alias("vec"))


def q_slot_mean_band(spark, sf_dir):
    b = S.slot_mean_band(S.slot_stats(_valid(spark, sf_dir)))
    return b.select("measurement", "slot", *[r(F.col(c)).alias(c) for c in ("mean", "std", "lower", "upper")])


def q_scalar_quantiles(spark, sf_dir):
    q = S.scalar_stats(_valid(spark, sf_dir))
    return q.select("measurement", *[r(F.col(c)).alias(c) for c in
                                     ("mean", "std", "low1000", "low100", "high100", "high1000")])


def q_value_histogram(spark, sf_dir):
    s = _valid(spark, sf_dir)
    return S.value_histogram(s, S.scalar_stats(s))


def q_in_range_not_nan(spark, sf_dir):
    s = _valid(spark, sf_dir)
    return S.in_range(s, S.scalar_stats(s)).groupBy("measurement").agg(F.count(F.lit(1)).alias("n_in_range"))


def q_uneven_stations(spark, sf_dir):
    u = S.uneven_stations(_valid(spark, sf_dir), UNEVEN_THRESHOLD)
    return u.select("station", r(F.col("count_var")).alias("count_var"))


def q_series_covariance(spark, sf_dir):
    c = S.covariance(_valid(spark, sf_dir))
    return c.select("measurement", "i", "j", "n", r(F.col("cov")).alias("cov"))


def _basis(spark, sf_dir):
    return S.series_pca(_valid(spark, sf_dir))


def q_series_pca(spark, sf_dir):
    b = _basis(spark, sf_dir)
    return b.select("measurement", "k", r(F.col("eigval")).alias("eigval"),
                    F.transform("eigvec", lambda x: r(x)).alias("eigvec"))


def q_explained_variance(spark, sf_dir):
    e = S.explained_variance(_basis(spark, sf_dir))
    return e.select("measurement", "k", r(F.col("explained")).alias("explained"))


def q_top_eigvecs(spark, sf_dir):
    t = S.top_eigvecs(_basis(spark, sf_dir), RECON_K)
    return t.select("measurement", "k", F.transform("eigvec", lambda x: r(x)).alias("eigvec"))


def _recon_inputs(spark, sf_dir):
    s = _valid(spark, sf_dir)
    return s, S.slot_stats(s), S.series_pca(s)


def q_project_coeffs(spark, sf_dir):
    s, st, b = _recon_inputs(spark, sf_dir)
    p = S.project_coeffs(s, st, b, RECON_K)
    return p.select("station", "measurement", "year", F.transform("coeffs", lambda x: r(x)).alias("coeffs"))


def q_reconstruct(spark, sf_dir):
    s, st, b = _recon_inputs(spark, sf_dir)
    rc = S.reconstruct(s, st, b, RECON_K)
    return rc.select("station", "measurement", "year", "j",
                     F.transform("rebuilt", lambda x: r(x)).alias("rebuilt"), r(F.col("error")).alias("error"))


def q_reconstruct_full(spark, sf_dir):
    """Rebuilt from all eigenvectors: the series themselves, with the mean in missing slots."""
    s, st, b = _recon_inputs(spark, sf_dir)
    rc = S.reconstruct(s, st, b, EVENT_SLOTS).where(F.col("j") == EVENT_SLOTS)
    return rc.select("station", "measurement", "year", F.transform("rebuilt", lambda x: r(x + OFF_TIE)).alias("rebuilt"))


def q_reconstruction_error(spark, sf_dir):
    s, st, b = _recon_inputs(spark, sf_dir)
    e = S.reconstruction_error(s, st, b, RECON_K)
    return e.select("station", "measurement", "year", r(F.col("error")).alias("error"))


def q_drop_nan_error(spark, sf_dir):
    s, st, b = _recon_inputs(spark, sf_dir)
    e = S.reconstruction_error(s, st, b, RECON_K)
    return S.drop_nan_error(e).groupBy("measurement").agg(F.count(F.lit(1)).alias("n_kept"))


def q_extreme_residuals(spark, sf_dir):
    s, st, b = _recon_inputs(spark, sf_dir)
    x = S.extreme_residuals(S.reconstruction_error(s, st, b, RECON_K))
    return x.select("measurement", "side", "rnk", "station", "year", r(F.col("error")).alias("error"))


QUERIES = {
    "scan_station_series": q_scan_station_series,
    "flatten_series": q_flatten_series,
    "valid_length": q_valid_length,
    "by_measurement": q_by_measurement,
    "slot_counts": q_slot_counts,
    "scan_series_stats": q_scan_series_stats,
    "slot_mean_band": q_slot_mean_band,
    "scalar_quantiles": q_scalar_quantiles,
    "value_histogram": q_value_histogram,
    "in_range_not_nan": q_in_range_not_nan,
    "uneven_stations": q_uneven_stations,
    "series_covariance": q_series_covariance,
    "series_pca": q_series_pca,
    "explained_variance": q_explained_variance,
    "top_eigvecs": q_top_eigvecs,
    "project_coeffs": q_project_coeffs,
    "scan_station_projections": q_scan_station_projections,
    "reconstruct": q_reconstruct,
    "reconstruct_full": q_reconstruct_full,
    "reconstruction_error": q_reconstruction_error,
    "drop_nan_error": q_drop_nan_error,
    "extreme_residuals": q_extreme_residuals,
}
