"""Array<double> vector expressions evaluated inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def sq_dist(a: Column, b: Column) -> Column:
    """Squared L2 distance of two equal-length arrays (NULL if any is NULL)."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)),
                       F.lit(0.0), lambda acc, v: acc + v)


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0),
                       lambda acc, v: acc + v)


def l2_norm(a: Column) -> Column:
    return F.sqrt(F.aggregate(a, F.lit(0.0), lambda acc, v: acc + v * v))


def to_double_array(a: Column) -> Column:
    return a.cast("array<double>")


def nan_to_null(a: Column) -> Column:
    """Missing markers at rest are NULL elements, never NaN."""
    return F.transform(a, lambda v: F.when(F.isnan(v), F.lit(None)).otherwise(v))
