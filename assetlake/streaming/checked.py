"""Rule counts of a stream (A15, Q3): observed per micro-batch, summed across restarts.

The kept rows go to the sink and the counts are gathered by ``observe`` in the same pass. Each progress
event brings the counts of its batch; a listener appends them as one small file for the batch, under
the query's id, which the checkpoint keeps across restarts. A batch that is run again after a failure
replaces its own counts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from assetlake.operators.quality import Rules, kept, rule_counts

OBSERVED = "rules"
COUNTS = "query string, batch long, rule string, action string, checked long, failed long"


class RuleCounts(StreamingQueryListener):
    """Writes the observed counts of each batch of one query name to a folder."""

    def __init__(self, spark: SparkSession, name: str, rules: Rules, path: str):
        self.spark, self.name, self.rules, self.path = spark, name, rules, path

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        seen = p.observedMetrics.get(OBSERVED) if p.name == self.name else None
        if seen is None or not seen["_checked"]:
            return  # a batch without rows has no counts
        rows = [(str(p.id), p.batchId, rule, action, seen["_checked"], seen[f"_f{i}"]) for i, (rule, _, action) in enumerate(self.rules.items())]
        self.spark.createDataFrame(rows, COUNTS).coalesce(1).write.mode("overwrite").parquet(f"{self.path}/query={p.id}/of_batch={p.batchId}")

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def start_checked(rows: DataFrame, rules: Rules, out_path: str, checkpoint: str, counts_path: str, name: str,
                  available_now: bool = True) -> tuple[StreamingQuery, RuleCounts]:
    """Start writing a streaming frame's kept rows. The listener stays registered until ``finish``."""
    spark = rows.sparkSession
    listener = RuleCounts(spark, name, rules, counts_path)
    spark.streams.addListener(listener)
    seen = rows.observe(OBSERVED, *rule_counts(rules))
    w = (kept(seen, rules).writeStream.queryName(name).format("parquet").option("checkpointLocation", checkpoint)
         .option("path", out_path).outputMode("append"))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start(), listener


def finish(query: StreamingQuery, listener: RuleCounts) -> None:
    """Wait for the query and the last of its progress events, and remove the listener."""
    query.awaitTermination()
    spark = listener.spark
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    spark.streams.removeListener(listener)


def summed(spark: SparkSession, counts_path: str) -> DataFrame:
    """(rule, action, checked, failed) over all batches and restarts of the stream."""
    files = spark.read.option("recursiveFileLookup", "true").schema(COUNTS).parquet(counts_path)
    return files.groupBy("rule", "action").agg(F.sum("checked").alias("checked"), F.sum("failed").alias("failed"))
