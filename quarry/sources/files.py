"""Readers for the reference's inputs when they come as files.

Each reader declares its schema (no inference pass) and accepts Parquet
(default) or CSV for the flat tables. The query registry runs on stand-ins
built from the test tables instead (``standins.py``); these are the entry
points for real data of the same shapes.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The shapes of the reference's inputs.
USER_GROUPS = "user_id string, group_id int"
SERIES_FIELDS = {"measurement": "string", "year": "int", "values": "array<double>"}
STATION_SERIES = ("station string, years array<struct<measurement: string, year: int, "
                  "values: array<double>>>")
STATION_PROJECTIONS = ("station string, TAVG_coeff array<double>, TRANGE_coeff array<double>, "
                       "SNWD_coeff array<double>, latitude double, longitude double, "
                       "elevation double, dist_coast double")
SCALAR_STATS = ("measurement string, mean double, std double, low1000 double, low100 double, "
                "high100 double, high1000 double")
SLOT_STATS = "measurement string, slot int, ne bigint, mean double, var double"
BASIS = "measurement string, k int, eigval double, eigvec array<double>"


def _read(spark: SparkSession, path: str, schema: str, fmt: str) -> DataFrame:
    r = spark.read.schema(schema)
    if fmt == "csv":
        return r.option("header", "true").csv(path)
    return r.format(fmt).load(path)


def read_user_groups(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """``(user_id, group_id)``: the user -> group mapping."""
    return _read(spark, path, USER_GROUPS, fmt)


def read_station_series(spark: SparkSession, path: str) -> DataFrame:
    """Nested station records; flatten with ``operators.series.flatten_series``."""
    return spark.read.schema(STATION_SERIES).parquet(path)


def scan_station_series(spark: SparkSession, path: str, fields: Sequence[str] = ("measurement", "year", "values")) -> DataFrame:
    """``(station, fields...)``, one row per series of the nested station records.

    The declared schema holds the fields asked for, so the file reader opens
    those leaves only (see ``ReadSchema`` in the plan): listing measurements
    and years reads no values. (Spark does not prune two fields behind one
    explode by itself.)
    """
    leaves = ", ".join(f"{name}: {SERIES_FIELDS[name]}" for name in fields)
    nested = spark.read.schema(f"station string, years array<struct<{leaves}>>").parquet(path)
    one = nested.select("station", F.explode("years").alias("y"))
    return one.select("station", *[F.col(f"y.{name}").alias(name) for name in fields])


def read_station_projections(spark: SparkSession, path: str) -> DataFrame:
    """Per station: three coefficient vectors and four location numbers."""
    return spark.read.schema(STATION_PROJECTIONS).parquet(path)


def scan_station_projections(spark: SparkSession, path: str) -> DataFrame:
    """``(name, vec)``: the station and its three coefficient vectors one behind the other.

    A station without one of the vectors has no such row. Location columns
    are not read.
    """
    p = read_station_projections(spark, path)
    vec = F.concat("TAVG_coeff", "TRANGE_coeff", "SNWD_coeff")
    return p.select(F.col("station").alias("name"), vec.alias("vec")).where(F.col("vec").isNotNull())


def read_series_stats(spark: SparkSession, path_scalars: str, path_slots: str,
                      path_basis: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The three statistics tables, when they were computed and saved earlier."""
    return (spark.read.schema(SCALAR_STATS).parquet(path_scalars),
            spark.read.schema(SLOT_STATS).parquet(path_slots),
            spark.read.schema(BASIS).parquet(path_basis))
