"""Label and feature shaping for the learners."""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarry.operators.joins import bounded_broadcast
from quarry.session import local_frame

# Class names of the cover-type table, by class code.
COVER_TYPES = {1: "Spruce/Fir", 2: "Lodgepole Pine", 3: "Ponderosa Pine",
               4: "Cottonwood/Willow", 5: "Aspen", 6: "Douglas-fir", 7: "Krummholz"}


def binarize_class(label: Column, cls: float) -> Column:
    """1.0 when the label equals ``cls`` else 0.0."""
    return (label == F.lit(cls)).cast("double")


def binarize_threshold(value: Column, threshold: float = 0.5) -> Column:
    """1.0 when the value is above ``threshold`` else 0.0."""
    return (value > F.lit(threshold)).cast("double")


def class_lookup(spark: SparkSession, names: dict = COVER_TYPES) -> DataFrame:
    """Small fixed lookup table ``(code, name)``."""
    return local_frame(spark, [(int(k), v) for k, v in names.items()], "code int, name string")


MAX_CLASSES = 100_000


def decode_class(df: DataFrame, label_col: str, lookup: DataFrame) -> DataFrame:
    """Add the class name; the lookup is broadcast after its size is checked."""
    small = bounded_broadcast(lookup, MAX_CLASSES)
    return df.join(small, df[label_col] == lookup["code"], "left").drop("code")


def class_distribution(df: DataFrame, label_col: str = "label", decimals: int = 6) -> DataFrame:
    """``(label, cnt, pct)`` largest class first; pct of all rows.

    The window over the aggregate sees one row per class only.
    """
    counts = df.groupBy(F.col(label_col).alias("label")).agg(F.count(F.lit(1)).alias("cnt"))
    pct = F.round(100.0 * F.col("cnt") / F.sum("cnt").over(Window.partitionBy()), decimals)
    return counts.select("label", "cnt", pct.alias("pct")).orderBy(F.col("cnt").desc(), F.col("label"))


def split_array_column(df: DataFrame, col: str, n: int, prefix: str | None = None) -> DataFrame:
    """Array of n -> columns ``{prefix}1..{prefix}n``; the array column is dropped."""
    prefix = prefix or col
    return df.select(*[c for c in df.columns if c != col],
                     *[F.col(col)[i].alias(f"{prefix}{i + 1}") for i in range(n)])


def concat_vectors(*cols: str) -> Column:
    return F.concat(*[F.col(c).cast("array<double>") for c in cols])


def slice_columns(df: DataFrame, names: list[str]) -> DataFrame:
    return df.select(*names)


def to_labeled(df: DataFrame, label: Column, feature_cols: list[str], out: str = "features") -> DataFrame:
    """``(label, features VECTOR)`` through the built-in assembler."""
    asm = VectorAssembler(inputCols=feature_cols, outputCol=out, handleInvalid="keep")
    return asm.transform(df.withColumn("label", label.cast("double"))).select("label", out, *[
        c for c in df.columns if c not in feature_cols and c != "label"])


def pair_predictions(labels: DataFrame, predictions: DataFrame, key: str) -> DataFrame:
    """``labels`` with the ``prediction`` of the same key; labels without one are left out.

    Both tables must have a key once. A join by key pairs the same rows
    however the two tables are partitioned or were recomputed, which a zip by
    position cannot promise.
    """
    return labels.join(predictions.select(key, "prediction"), key)
