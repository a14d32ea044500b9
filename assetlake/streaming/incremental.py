"""Incremental bronze -> silver -> gold with one Structured Streaming query.

The surveyed pipeline streams only bronze and recomputes silver and gold
from every image on each run. Here each micro-batch of at most
``max_files`` new files goes through all three layers:

* bronze rows of the batch are appended;
* the batch's files are decoded by the ``image`` source and standardised in
  one Arrow pass, joined with the batch's metadata (both sides hold at most
  ``max_files`` rows), checked by the drop/warn rules, appended to silver;
* gold rows are a pure per-row map of silver (config ids and a hash split,
  which does not depend on what else is in the batch), appended to gold.

Exactly-once: every layer is written with dynamic partition overwrite on a
``batch_id`` partition, so a micro-batch that is re-run after a failure
replaces its own output instead of adding to it, and the checkpoint records
which batches are done.
"""

from __future__ import annotations

import re

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from assetlake.operators.quality import apply_rules_observed, observed_report
from assetlake.plans.medallion import gold, silver_rows, silver_rules, wanted_files
from assetlake.sources.files import MAX_FILES_PER_TRIGGER
from assetlake.streaming.bronze import bronze_stream

_GLOB = re.compile(r"([\\*?\[\]{}])")


def _escape_glob(path: str) -> str:
    """File names are loaded as literal paths, not glob patterns."""
    return _GLOB.sub(r"\\\1", path)


def _write(df: DataFrame, path: str, batch_id: int, partition_by: list[str]) -> None:
    (df.withColumn("batch_id", F.lit(batch_id))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("batch_id", *partition_by).parquet(path))


def process_batch(spark: SparkSession, batch: DataFrame, batch_id: int, out_root: str,
                  key_to_group: DataFrame, keys: list[str], groups: list[str], seed: int = 42) -> None:
    b = batch.persist(StorageLevel.MEMORY_AND_DISK)  # at most max_files rows
    try:
        _write(b, f"{out_root}/bronze", batch_id, ["food_type"])
        # the batch's own file names: bounded by max_files, never the table. What a header refuses isn't decoded.
        paths = [r.path for r in wanted_files(b).select("path").collect()]
        if not paths:
            return
        images = (spark.read.format("image").option("dropInvalid", "false")
                  .load([_escape_glob(p) for p in paths])
                  .select(F.col("_metadata.file_path").alias("source_file"), F.col("image")))
        rules = silver_rules()
        # the counts come from the pass that fills the cache: one decode a file
        kept, counts = apply_rules_observed(silver_rows(b, images, key_to_group), rules)
        kept = kept.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            _write(kept, f"{out_root}/silver", batch_id, ["cuisine_category"])
            _write(observed_report(spark, counts, rules), f"{out_root}/dq_report", batch_id, [])
            _write(gold(kept, keys, groups, seed), f"{out_root}/gold", batch_id, ["dataset_split"])
        finally:
            kept.unpersist()
    finally:
        b.unpersist()


def start_incremental(spark: SparkSession, root: str, out_root: str, checkpoint: str,
                      key_to_group: DataFrame, keys: list[str], groups: list[str], seed: int = 42,
                      max_files: int = MAX_FILES_PER_TRIGGER, available_now: bool = True) -> StreamingQuery:
    """Start the three-layer stream over ``{root}/{key}/*``.

    ``out_root`` and ``checkpoint`` must lie outside ``root``: the source
    lists ``root`` recursively and would read its own output.
    """
    lut = key_to_group.persist()  # config-sized lookup, reused by every batch
    w = (bronze_stream(spark, root, max_files).writeStream
         .foreachBatch(lambda df, bid: process_batch(spark, df, bid, out_root, lut, keys, groups, seed))
         .option("checkpointLocation", checkpoint))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()
