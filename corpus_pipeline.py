"""Training-data pipeline over ``documents``: from raw texts to packed sequences.

Stages, each on all rows that the one before kept: quality classifier, quality
rules, near-duplicate removal, removal of repeated passages, packing. All but
the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import minhash, packing, quality_model, quality_rules, substrings
from quarry.llm.common import checkpointed, held_out
from quarry.llm.queries import PACK_TOKENIZER
from quarry.sources.tables import read_table


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that the nearest labelled neighbours (op 10) score below the threshold.

    Labels of held-out ids are not learned from. Null texts count as empty.
    """
    labels = read_table(spark, sf_dir, "labels").where(~held_out("doc_id"))
    return quality_model.filter_rows(docs, quality_model.fit(docs, labels))


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that fail a rule of the default policy (op 5)."""
    return quality_rules.filter_rows(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the least id of every group of near-duplicates (op 7).

    A row stays or goes by the verdict on its own text. Of rows with one id
    and equal sets (without a set: equal texts) one stays, that of the least
    hash. Rows without an id stay.
    """
    keyed = docs.withColumn("text_key", F.xxhash64("text"))
    stays = (minhash.near_duplicates(keyed, carry="text_key").where("kept AND doc_id IS NOT NULL")
             .groupBy("doc_id", "digest", F.when(F.col("digest").isNull(), F.col("text_key")).alias("bare"))
             .agg(F.min("text_key").alias("text_key")).select("doc_id", "text_key"))
    named = keyed.join(stays, ["doc_id", "text_key"], "left_semi").dropDuplicates(["doc_id", "text_key"])
    return named.select(*docs.columns).unionByName(docs.where("doc_id IS NULL"))


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Remove passages of 50 bytes or more that a smaller id has (op 3).

    Characters that a removed span cuts go with it; ``n_chars`` is counted
    anew. A document of which nothing is left stays with an empty text.
    """
    others = [c for c in docs.columns if c not in ("doc_id", "text", "n_chars")]
    done = substrings.remove_repeats(docs, carry=tuple(others), as_text=True)
    return (done.withColumnRenamed("kept", "text").withColumn("n_chars", F.length("text").cast("bigint"))
            .select(*docs.columns))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack what is left into sequences of at most 4,096 ids (op 8): one row per piece, with its ids."""
    return packing.pack(docs, PACK_TOKENIZER).withColumn("ids_crc32", F.crc32("ids"))


STAGES = [
    ("quality_classifier", quality_classifier),
    ("quality_rules", rules),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("packing", packed),
]

#: SQL cannot express the classifier, the tokenizer or the packing.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; what a stage keeps is checkpointed before the next one reads it."""
    docs = read_table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, checkpointed(docs) if k else docs, sf_dir)
    return docs
