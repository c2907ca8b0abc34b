"""Seeded, key-based sampling and splits.

Each row's draw is ``hash_uniform(key, salt)``, so a split is a pure function
of the data: it repeats across runs, survives task retries on lost
executors, and needs no shuffle. A row with a NULL key draws by its other
columns, so such rows are spread as well (whole copies stay together).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.functions.hashing import hash_uniform


def _u(df: DataFrame, key: str | Column, salt: str) -> Column:
    k = F.col(key) if isinstance(key, str) else key
    row = F.xxhash64(*[F.col(f.name) for f in df.schema.fields if not _has_map(f.dataType)])   # maps cannot be hashed
    return hash_uniform(F.coalesce(k.cast("string"), F.concat(F.lit("row "), row.cast("string"))), salt)


def _has_map(kind) -> bool:
    return "map<" in kind.simpleString()


def sample_fraction(df: DataFrame, key: str | Column, fraction: float, salt: str = "sample") -> DataFrame:
    """Rows whose key draw is below ``fraction`` (without replacement)."""
    return df.where(_u(df, key, salt) < fraction)


def split_by_weights(df: DataFrame, key: str | Column, weights=(0.7, 0.3),
                     names=("train", "test"), salt: str = "split", col: str = "split") -> DataFrame:
    """Add a split label; row goes to the first name whose cumulative weight exceeds its draw."""
    total = float(sum(weights))
    u = _u(df, key, salt)
    expr, acc = None, 0.0
    for w, name in zip(weights[:-1], names[:-1]):
        acc += w / total
        expr = F.when(u < acc, F.lit(name)) if expr is None else expr.when(u < acc, F.lit(name))
    expr = F.lit(names[-1]) if expr is None else expr.otherwise(F.lit(names[-1]))
    return df.withColumn(col, expr)


def split_half(df: DataFrame, key: str | Column, salt: str = "half", col: str = "split") -> DataFrame:
    return split_by_weights(df, key, (0.5, 0.5), ("train", "test"), salt, col)


def mask_split(df: DataFrame, col: str = "split", names=("train", "test")) -> tuple[DataFrame, ...]:
    """One frame per split value of a stored split column."""
    return tuple(df.where(F.col(col) == n) for n in names)
