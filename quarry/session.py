"""Session construction and cluster-facing settings."""

from __future__ import annotations

import atexit
import contextlib
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every job here relies on. AQE re-plans joins and coalesces
# shuffle partitions from runtime sizes; skew-join splits hot partitions.
_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "quarry") -> SparkSession:
    """A local session for tests and benchmarks (a cluster passes its own)."""
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    for k, v in _DEFAULTS.items():
        builder = builder.config(k, v)
    builder = (builder
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", os.environ.get("QUARRY_DRIVER_MEMORY", "8g")))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster that setting names a shared file system folder and is used
    as is; without it this raises, because executors would write to folders
    that nobody else sees. Only a local master gets a scratch folder (tests).
    """
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not is_local(spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="quarry-ckpt-")
    spark.sparkContext.setCheckpointDir(configured)
    return spark.sparkContext.getCheckpointDir() or configured


def is_local(master: str) -> bool:
    """True if driver and executors are one process (``local-cluster`` is not)."""
    return master == "local" or master.startswith("local[")


#: Folders under the shared one that this process has written and not removed yet, with the session that wrote them.
_SHARED: dict[str, SparkSession] = {}


def shared_path(spark: SparkSession, kind: str) -> str:
    """A new path under the shared folder; removed by ``remove_shared`` or at the end of the application."""
    if not _SHARED:
        atexit.register(remove_shared)
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/quarry-{kind}/{uuid.uuid4().hex}"
    _SHARED[path] = spark
    return path


def remove_shared(*paths: str) -> None:
    """Remove these paths, or all that ``shared_path`` gave; results that still read them must have been used."""
    for path in paths or tuple(_SHARED):
        spark = _SHARED.pop(path, None)
        if spark is not None:
            with contextlib.suppress(Exception):   # the application may be ending
                at = spark._jvm.org.apache.hadoop.fs.Path(path)
                at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def written_table(df: DataFrame) -> DataFrame:
    """Cut the lineage with a table written once to the shared folder; readers prune its columns."""
    path = shared_path(df.sparkSession, "tables")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stable_checkpoint_base(spark: SparkSession) -> str:
    """The configured shared folder itself (same for every application).

    Streaming queries keep their state and progress here so that a restarted
    application resumes them; ``ensure_checkpoint_dir`` is per application.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    return configured or ensure_checkpoint_dir(spark)


def local_frame(spark: SparkSession, rows: list, schema: str):
    """A DataFrame of a few driver-side result rows (bounded by parameters).

    Built from pandas through Arrow, so it is a local relation: running it
    needs no Python worker and no parallelized RDD.
    """
    import pandas as pd
    from pyspark.sql.types import _parse_datatype_string

    st = _parse_datatype_string(schema)
    pdf = pd.DataFrame(rows, columns=[f.name for f in st.fields])
    return spark.createDataFrame(pdf, st)


class persisted:
    """Keep a frame that several actions reuse; always released afterwards.

    ``with persisted(df) as d: ...`` persists with MEMORY_AND_DISK (a lost
    block is rebuilt from lineage) and unpersists when the block ends.
    """

    def __init__(self, df):
        from pyspark import StorageLevel
        self.df = df.persist(StorageLevel.MEMORY_AND_DISK)

    def __enter__(self):
        return self.df

    def __exit__(self, *exc):
        self.df.unpersist()
        return False
