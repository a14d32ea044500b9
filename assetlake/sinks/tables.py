"""Table sinks (K1-K5, K9, K10, U1 views).

One partitioned table per layer instead of a table per key: the write is
rebalanced on the partition column first, so each partition folder gets a
few well-sized files rather than one small file per task.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def _text(value) -> str:
    """A SQL string literal."""
    return "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"


def _name(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def write_partitioned(df: DataFrame, table: str, partition_by: list[str], mode: str = "overwrite",
                      comment: str | None = None, properties: dict | None = None, path: str | None = None) -> None:
    """K2/K5: batch table write, partitioned, with comment and properties."""
    w = df.hint("rebalance", *partition_by).write.mode(mode).partitionBy(*partition_by).format("parquet")
    if path:
        w = w.option("path", path)
    w.saveAsTable(table)
    spark = df.sparkSession
    if comment:
        spark.sql(f"COMMENT ON TABLE {table} IS {_text(comment)}")
    if properties:
        props = ", ".join(f"{_text(k)} = {_text(v)}" for k, v in properties.items())
        spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ({props})")


def write_bucketed(df: DataFrame, table: str, key: str, buckets: int, mode: str = "overwrite",
                   path: str | None = None) -> None:
    """Write a snapshot bucketed and sorted by its id. Two snapshots written
    with the same key and bucket count join on that key without a shuffle
    (``snapshot_changes`` on 100 TB then moves no table data)."""
    w = df.write.mode(mode).format("parquet").bucketBy(buckets, key).sortBy(key)
    if path:
        w = w.option("path", path)
    w.saveAsTable(table)


def views_by(spark: SparkSession, table: str, column: str, values: list[str], prefix: str) -> list[str]:
    """K3/K4: one view per key/group over the single partitioned table
    (partition pruning turns each view into a scan of its folder only)."""
    names = []
    for v in values:
        name = f"{prefix}{v}"
        spark.sql(f"CREATE OR REPLACE TEMP VIEW {_name(name)} AS SELECT * FROM {table} WHERE {_name(column)} = {_text(v)}")
        names.append(name)
    return names


def metric_rows(frames: list[DataFrame], params: dict[str, str] | None = None) -> DataFrame:
    """K9: long-form run rows (kind, name, value, text) from one-row metric
    frames; only numeric metrics are kept, parameters are text rows."""
    parts = []
    for f in frames:
        for fld in f.schema.fields:
            if isinstance(fld.dataType, NUMERIC):
                parts.append(f.select(F.lit("metric").alias("kind"), F.lit(fld.name).alias("name"),
                                      F.col(fld.name).cast("double").alias("value"),
                                      F.lit(None).cast("string").alias("text")))
    spark = frames[0].sparkSession if frames else SparkSession.getActiveSession()
    if params:
        parts.append(spark.createDataFrame([("param", k, None, str(v)) for k, v in params.items()],
                                           "kind string, name string, value double, text string"))
    return reduce(lambda a, b: a.unionByName(b), parts)


def log_run(df_rows: DataFrame, table: str, run_id: str) -> None:
    """K9: append a run's rows with its id and time."""
    (df_rows.withColumn("run_id", F.lit(run_id)).withColumn("ts", F.current_timestamp())
     .write.mode("append").format("parquet").saveAsTable(table))


def append_status(status: DataFrame, table: str) -> int:
    """K8: append this run's status rows, then a row that marks the run complete. Returns the run's number.

    Nothing is dropped or overwritten: until the mark is there, readers see the runs before. The
    status must not read ``table`` lazily in a way that sees its own rows: ``ingest`` pins it.
    """
    spark = status.sparkSession
    run = 1
    if spark.catalog.tableExists(table):
        run += spark.table(table).agg(F.coalesce(F.max("run"), F.lit(0))).first()[0]  # runs that were cut short too
    rows = status.withColumn("run", F.lit(run).cast("bigint")).withColumn("complete", F.lit(False))
    rows.write.mode("append").format("parquet").saveAsTable(table)
    mark = rows.limit(0).unionByName(spark.createDataFrame([(run, True)], "run long, complete boolean"), allowMissingColumns=True)
    mark.coalesce(1).write.mode("append").format("parquet").saveAsTable(table)
    return run


def current_status(spark: SparkSession, table: str) -> DataFrame:
    """K8: the latest row of each key over the runs that were completed."""
    log = spark.table(table)
    fields = [c for c in log.columns if c not in ("key", "run", "complete")]
    done = log.where("complete").select(F.col("run").alias("_done"))  # a row for each run
    rows = log.where(~F.col("complete")).join(done, F.col("run") == F.col("_done"), "left_semi")
    latest = rows.groupBy("key").agg(F.max_by(F.struct(*fields), "run").alias("s"))
    return latest.select("key", *(F.col(f"s.{c}").alias(c) for c in fields))


def register_model(spark: SparkSession, table: str, name: str, path: str, alias: str | None = None,
                   tags: dict[str, str] | None = None) -> int:
    """Append a (name, version, alias, path, tags) row; version = previous + 1.

    Reads only the model table's ``version`` column (one row per saved
    model, small by nature)."""
    version = 1
    if spark.catalog.tableExists(table):
        mx = spark.table(table).filter(F.col("name") == name).agg(F.max("version")).first()[0]
        version = (mx or 0) + 1
    row = spark.createDataFrame([(name, version, alias, path, tags or {})],
                                "name string, version int, alias string, path string, tags map<string,string>")
    row.withColumn("ts", F.current_timestamp()).write.mode("append").format("parquet").saveAsTable(table)
    return version
