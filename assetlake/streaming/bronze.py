"""Bronze ingestion as one Structured Streaming query.

One stream over ``{root}/*/`` replaces a stream per key: the key is the
parent folder name, and the sink is partitioned by it. The file sink plus
the checkpoint give exactly-once appends; ``availableNow`` drains what is
there in micro-batches of ``max_files`` and stops, so the job can be
scheduled like a batch and survives executor loss (a failed micro-batch is
re-run from the checkpoint).
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

from assetlake.plans.medallion import bronze
from assetlake.sources.files import MAX_FILES_PER_TRIGGER, binary_stream


def bronze_stream(spark: SparkSession, root: str, max_files: int = MAX_FILES_PER_TRIGGER):
    """The streaming bronze DataFrame (not started)."""
    return bronze(binary_stream(spark, root, max_files), key_from_dir=True)


def start_bronze(spark: SparkSession, root: str, out_path: str, checkpoint: str,
                 max_files: int = MAX_FILES_PER_TRIGGER, table: str | None = None,
                 available_now: bool = True) -> StreamingQuery:
    """Start the bronze stream into a parquet folder (or a table), partitioned by key."""
    w = (bronze_stream(spark, root, max_files).writeStream
         .format("parquet")
         .option("checkpointLocation", checkpoint)
         .partitionBy("food_type")
         .outputMode("append"))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    if table:
        return w.option("path", out_path).toTable(table)
    return w.start(out_path)
