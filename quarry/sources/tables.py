"""Parquet tables of a data directory, read with declared schemas.

``read_table`` names the file and its schema (so no job runs to infer the
schema from file footers); column pruning and filter pushdown come from the
projections and predicates the operators apply afterwards.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

# Column layouts of the test tables.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": ("o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
               "o_orderdate timestamp_ntz, o_orderpriority string"),
    "lineitem": ("l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                 "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                 "l_linestatus string, l_shipdate timestamp_ntz"),
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "pages": "page_id bigint, url string, html string",
    "benchmark": "item_id bigint, text string",
    "labels": "doc_id bigint, quality int, toxic int",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}
TABLES = tuple(SCHEMAS)


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name not in SCHEMAS:
        raise ValueError(f"unknown table {name!r}")
    return spark.read.schema(SCHEMAS[name]).parquet(table_path(sf_dir, name))


def spread(df: DataFrame, min_partitions: int | None = None, max_rows: int | None = None) -> DataFrame:
    """Round-robin repartition when a scan has fewer partitions than the cluster.

    Used before CPU-heavy per-row work (sentence splitting, tokenizing). A
    large table already arrives in many splits and is returned unchanged; a
    small file with one row group would otherwise be processed by one task.
    Meant for scans and narrow transformations of them: only the partition
    count of the planned scan is looked at, so no job runs (below a shuffle
    the adaptive plan would have to run its stages first). With ``max_rows``
    there are also as many partitions as that many rows each ask for; the
    rows are counted from the file footers, and a learner that keeps its
    rows in memory then holds blocks of a size that the table does not change.
    """
    target = min_partitions or df.sparkSession.sparkContext.defaultParallelism
    if max_rows:
        target = max(target, -(-df.count() // max_rows))
    if df.rdd.getNumPartitions() >= target:
        return df
    return df.repartition(target)
