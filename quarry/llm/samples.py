"""Bounded samples of labelled rows for fitting classifiers on the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.operators.joins import bounded_broadcast

MAX_CLASSES = 100_000
_SCALE = 1 << 40


def per_class(rows: DataFrame, id_col: str, class_col: str, bound: int) -> DataFrame:
    """At most ``bound`` rows (id, class) of each class, those of the least id hashes.

    The choice depends on ids alone. A class's count first sets a threshold
    on the hash that leaves ``bound`` rows and eight standard deviations more,
    so what moves and is ranked is about ``bound`` rows a class however many
    it has and however many tasks read them.
    """
    src = (rows.select(F.col(id_col).alias("id"), F.col(class_col).alias("class"))
           .where("id IS NOT NULL AND class IS NOT NULL")
           .withColumn("draw", F.pmod(F.xxhash64("id"), F.lit(_SCALE))))
    counts = src.groupBy("class").agg(F.count(F.lit(1)).alias("n"))
    share = F.lit(float(bound + 8 * bound ** 0.5 + 20)) / F.col("n")
    near = src.join(bounded_broadcast(counts, MAX_CLASSES), "class").where(F.col("draw") < share * _SCALE)
    order = Window.partitionBy("class").orderBy("draw", "id")
    return (near.select("id", "class", "draw").distinct()
            .withColumn("place", F.row_number().over(order)).where(F.col("place") <= bound).select("id", "class"))
