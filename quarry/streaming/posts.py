"""Posts per user group over a directory that receives JSON-line files.

The reference's posts were collected from a stream and then processed as
files; this is the same parse -> group lookup -> count plan as a Structured
Streaming query, so counts stay current as files arrive. The group mapping
is a static table (stream-static left join); the running counts are
streaming state kept in the checkpoint folder under ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from quarry.operators.posts import user_to_group
from quarry.session import stable_checkpoint_base
from quarry.sources.json import scan_json_records


def posts_per_group_stream(spark: SparkSession, lines_dir: str, groups: DataFrame,
                           max_files_per_trigger: int = 1000) -> DataFrame:
    """Streaming ``(group_id, n_posts)`` over the text files arriving in ``lines_dir``."""
    lines = spark.readStream.option("maxFilesPerTrigger", max_files_per_trigger).text(lines_dir)
    posts = scan_json_records(lines)
    return user_to_group(posts, groups).groupBy("group_id").count().withColumnRenamed("count", "n_posts")


def start_to_memory(spark: SparkSession, counts: DataFrame, name: str) -> StreamingQuery:
    """Run the counts into an in-memory table ``name`` (complete mode).

    The checkpoint is ``<spark.checkpoint.dir>/streams/<name>``: a query
    started again under the same name resumes from it.
    """
    ckpt = os.path.join(stable_checkpoint_base(spark), "streams", name)
    return (counts.writeStream.outputMode("complete").format("memory").queryName(name)
            .option("checkpointLocation", ckpt).start())
