"""Text sources: paragraph records and manifest-listed line files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quarry.functions.text import PARAGRAPH_SEPARATOR
from quarry.sources.manifest import ManifestLines


def scan_paragraphs(spark: SparkSession, paths: str | list[str],
                    separator: str = PARAGRAPH_SEPARATOR) -> DataFrame:
    """One row per paragraph of text files whose records end at ``separator``.

    The text source splits files itself, so a large book is read in parallel
    by byte ranges; records keep their single line breaks.
    """
    return spark.read.option("lineSep", separator).text(paths).withColumnRenamed("value", "paragraph")


def read_manifest_paths(spark: SparkSession, manifest: str) -> list[str]:
    """Paths listed one per line in a small manifest file, trimmed.

    For ``listed`` scans: bounded by the number of files, not their content.
    """
    rows = spark.read.text(manifest).collect()
    return [r.value.strip() for r in rows if r.value.strip()]


def scan_manifest_lines(spark: SparkSession, manifest: str, listed: bool = False, group: int = 64 << 10,
                        missing: str = "fail") -> DataFrame:
    """All lines of the files named in ``manifest`` as ``value STRING``.

    The manifest's byte ranges of ``group`` bytes are the partitions of a
    Python data source: a task reads the names that begin in its range and
    streams the lines of those files, so neither the list nor a plan entry
    per file passes through the driver. The files must lie where every
    executor can open them (a shared mount); ``missing`` says whether an
    absent one fails the job or is skipped (``skip``). With ``listed`` the
    names are read on the driver and Spark's text source opens the files, for
    stores that only Spark can read.
    """
    if listed:
        return spark.read.text(read_manifest_paths(spark, manifest))
    spark.dataSource.register(ManifestLines)
    return spark.read.format(ManifestLines.name()).option("group", str(group)).option("missing", missing).load(manifest)
