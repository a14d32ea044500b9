"""Snapshot diff and change log (K6): insert / update / delete rows between table versions.

The surveyed tables only set a change-feed property; here the change set is
computed from two snapshots with one full outer join on the id (a single
shuffle of both sides on the key; AQE splits a skewed key partition) and a
null-safe comparison of every payload column.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def snapshot_changes(old: DataFrame, new: DataFrame, key: str, keep_same: bool = False) -> DataFrame:
    payload = [c for c in new.columns if c != key]
    o = old.select(F.col(key), F.struct(*[F.col(c) for c in payload]).alias("_old"), F.lit(True).alias("_in_old"))
    n = new.select(F.col(key), F.struct(*[F.col(c) for c in payload]).alias("_new"), F.lit(True).alias("_in_new"))
    j = o.join(n, key, "full_outer")
    same = reduce(lambda a, b: a & b,
                  [F.col(f"_old.{c}").eqNullSafe(F.col(f"_new.{c}")) for c in payload], F.lit(True))
    kind = (F.when(F.col("_in_old").isNull(), F.lit("insert"))
            .when(F.col("_in_new").isNull(), F.lit("delete"))
            .when(same, F.lit("same"))
            .otherwise(F.lit("update")))
    out = j.select(F.col(key), kind.alias("change_type"))
    return out if keep_same else out.filter(F.col("change_type") != "same")


# ---------------------------------------------------------------- change log

CHANGE_COLUMNS = ["change_type", "version"]


def changes_between(old: DataFrame, new: DataFrame, key: str, version: int) -> DataFrame:
    """The rows that lead from one snapshot to the next: key, payload, change_type and version.

    A deletion carries the payload that went. ``old`` and ``new`` have the same columns; a key is
    one row of each (of repeated ones the greatest payload counts).
    """
    payload = [c for c in new.columns if c != key]

    def one(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy(F.col(key).alias(f"_{name}_key")).agg(F.max(F.struct(*payload)).alias(f"_{name}"))

    j = one(old, "old").join(one(new, "new"), F.col("_old_key").eqNullSafe(F.col("_new_key")), "full_outer")
    was, now = F.col("_old").isNotNull(), F.col("_new").isNotNull()
    kind = F.when(was & ~now, "delete").when(now & ~was, "insert").when(~F.col("_old").eqNullSafe(F.col("_new")), "update")
    rows = j.withColumn("change_type", kind).where("change_type IS NOT NULL")
    key_of = F.when(now, F.col("_new_key")).otherwise(F.col("_old_key"))
    return rows.select(key_of.alias(key), F.coalesce("_new", "_old").alias("_p"), "change_type", F.lit(version).cast("long").alias("version")).select(
        key, "_p.*", *CHANGE_COLUMNS)


def append_changes(changes: DataFrame, path: str) -> None:
    """Add one version to the log at ``path``; writing a version again replaces it, others stay as they are."""
    (changes.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("version").parquet(path))


def read_changes(spark: SparkSession, path: str, first: int, last: int | None = None) -> DataFrame:
    """The feed from version ``first`` to ``last`` (both included); only these versions' files are read."""
    log = spark.read.parquet(path).withColumn("version", F.col("version").cast("long"))
    return log.where(F.col("version") >= first) if last is None else log.where(F.col("version").between(first, last))


def state_at(spark: SparkSession, path: str, key: str, version: int | None = None) -> DataFrame:
    """The table as of a version (default: the last): each key's latest change, deletions left out.

    One aggregation by key with map-side partial results; no version is replayed on its own.
    """
    log = read_changes(spark, path, 0, version)
    payload = [c for c in log.columns if c not in (key, *CHANGE_COLUMNS)]
    latest = log.groupBy(key).agg(F.max_by(F.struct("change_type", *payload), "version").alias("_s"))
    return latest.where("_s.change_type <> 'delete'").select(key, *(F.col(f"_s.{c}").alias(c) for c in payload))


def compacted(spark: SparkSession, path: str, key: str, into: str, version: int) -> None:
    """A log of the same state at ``version`` and the same changes after it, at another path."""
    append_changes(state_at(spark, path, key, version).withColumn("change_type", F.lit("insert")).withColumn("version", F.lit(version).cast("long")), into)
    append_changes(read_changes(spark, path, version + 1), into)
