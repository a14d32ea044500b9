"""Exact, distributed ordering helpers.

Spark's ``row_number().over(Window.orderBy(..))`` without a partition moves
every row into a single task. These helpers give exact global positions
without that: rows are placed in hash or range buckets, bucket sizes are
aggregated (a table whose size is bounded by the bucket count, not by the
data), and only the rows of one boundary bucket are ranked one by one.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assetlake.session import checkpoint_dir

# Number of fine buckets the unit interval is cut into. The bucket histogram
# has at most this many rows whatever the data size, and a bucket holds about
# rows/65536 rows when ordering keys are distinct.
FINE_BUCKETS = 1 << 16
# Digits of 16 bits that a double in [0, 1) has.
LEVELS = 3
# Distinct keys that are ranked in one task.
SMALL = 100_000


def unit_hash(seed: int, *cols) -> Column:
    """A repeatable uniform value in [0, 1) from ``seed`` and ``cols``.

    First 32 bits of md5("{seed}:{c1}:{c2}..") over 2^32. Independent of
    partitioning (unlike ``rand``) and reproducible in SQL engines that have
    md5 (the oracles use the same formula).
    """
    parts = [F.lit(f"{seed}")]
    for c in cols:
        # a null id hashes as the text \N, so u is never null
        parts += [F.lit(":"), F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit("\\N"))]
    hexed = F.substring(F.md5(F.concat(*parts)), 1, 8)
    return F.conv(hexed, 16, 10).cast("bigint") / F.lit(4294967296.0)


def _digits(u: Column, level: int) -> Column:
    """The first ``level`` digits of 16 bits of a number in [0, 1), as one whole number."""
    return F.floor(u * float(FINE_BUCKETS ** level)).cast("bigint")


def _radix_boundary(df: DataFrame, u: str, k: int) -> tuple[int, int, int, int] | None:
    """Where the k-th value lies: (level, its leading digits, rows still wanted among them, rows that have them).

    One histogram of at most 65,536 cells for each digit; the next digit is looked at only inside the
    boundary cell, and only while that holds many rows. None: fewer than k rows.
    """
    cell, need, rows = 0, k, df
    for level in range(1, LEVELS + 1):
        hist = rows.groupBy((_digits(F.col(u), level) - cell * FINE_BUCKETS).alias("_b")).agg(F.count(F.lit(1)).alias("_n"))
        before = 0
        for r in hist.orderBy("_b").collect():  # at most 65,536 rows
            if before + r["_n"] >= need:
                break
            before += r["_n"]
        else:
            return None
        cell, need = cell * FINE_BUCKETS + r["_b"], need - before
        if r["_n"] <= SMALL:
            break
        rows = df.where(_digits(F.col(u), level) == cell)
    return level, cell, need, r["_n"]


def _kth_key(keys: DataFrame, order: list[Column], k: int, partitions: int):
    """The row of distinct ``keys`` (with counts ``_n``) that holds the k-th row, and how many rows are before it.

    Keys are sorted by range, so each range is ranked in a task of its own; a range's total is one row.
    """
    checkpoint_dir(keys.sparkSession)
    placed = (keys.repartitionByRange(partitions, *order) if partitions > 1 else keys.coalesce(1)).withColumn("_pid", F.spark_partition_id())
    placed = placed.checkpoint(eager=True)
    before = 0
    for r in placed.groupBy("_pid").agg(F.sum("_n").alias("_n")).orderBy("_pid").collect():
        if before + r["_n"] >= k:
            break
        before += r["_n"]
    running = F.sum("_n").over(Window.partitionBy("_pid").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    row = (placed.where(F.col("_pid") == r["_pid"]).withColumn("_cum", running + before)
           .where(F.col("_cum") >= k).orderBy("_cum").first())
    return row, row["_cum"] - row["_n"]


def first_k(df: DataFrame, u: str, ties: list[str], k: int, out: str = "in_first_k") -> DataFrame:
    """Flag exactly the ``k`` first rows in the order (u, *ties), u in [0, 1).

    The boundary is found by radix selection on ``u`` (a histogram a digit, inside the boundary cell
    only), then among the keys that share its digits by ranges; what reaches the driver is bounded by
    a histogram or by the number of ranges, never by the data, and no task ranks more than about
    ``SMALL`` keys. Copies of the boundary key are split by input partition, so a key holding a third
    of all rows is still spread over many tasks.
    """
    if k <= 0:
        return df.withColumn(out, F.lit(False))
    found = _radix_boundary(df, u, k)
    if found is None:  # fewer than k rows: all are in
        return df.withColumn(out, F.lit(True))
    level, cell, need, crowd = found
    digits = _digits(F.col(u), level)
    order_key = [F.col(u)] + [F.col(t) for t in ties]
    keys = df.where(digits == cell).groupBy(u, *ties).agg(F.count(F.lit(1)).alias("_n"))
    krow, before = _kth_key(keys, order_key, need, max(1, -(-crowd // SMALL)))
    key_vals = [krow[u]] + [krow[t] for t in ties]
    need2 = need - before

    less, is_key = F.lit(False), F.lit(True)
    for c, v in zip(order_key, key_vals):
        below = F.lit(False) if v is None else F.coalesce(c < F.lit(v), F.lit(True))  # nulls come first
        less = less | (is_key & below)
        is_key = is_key & c.eqNullSafe(F.lit(v))
    flag = (digits < cell) | ((digits == cell) & less)
    if krow["_n"] == need2:
        return df.withColumn(out, flag | is_key)

    # The boundary key has copies and only some are taken: split them by
    # input partition. Pin the copies first so partition ids and row
    # positions are identical in the counting and selecting passes.
    checkpoint_dir(df.sparkSession)
    staged = (df.filter(is_key)
              .withColumn("_pid", F.spark_partition_id())
              .withColumn("_mid", F.monotonically_increasing_id())
              .persist(StorageLevel.MEMORY_AND_DISK))
    copies = staged.checkpoint(eager=True)
    staged.unpersist()
    per = copies.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    wp = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, 0)
    quota = (per.withColumn("_before", F.sum("_n").over(wp) - F.col("_n"))
             .withColumn("_q", F.greatest(F.lit(0), F.least(F.col("_n"), F.lit(need2) - F.col("_before"))))
             .select("_pid", "_q"))
    wi = Window.partitionBy("_pid").orderBy("_mid")
    # quota has one row per input partition: bounded by the partition count
    picked = (copies.join(F.broadcast(quota), "_pid")
              .withColumn("_i", F.row_number().over(wi) - 1)
              .withColumn(out, F.col("_i") < F.col("_q"))
              .drop("_pid", "_mid", "_q", "_i"))
    return df.filter(~is_key).withColumn(out, flag).unionByName(picked)


def dense_ids(values: DataFrame, col: str, out: str = "id", partitions: int | None = None, kind: str = "int") -> DataFrame:
    """0-based dense ids of the distinct values of ``col`` in ascending order.

    Range-partitions the distinct values, pins them with a reliable
    checkpoint (so partition contents are fixed), and adds each partition's
    offset (a table of one row per partition) to the position inside it.
    ``kind`` is the type of the ids; more than 2^31 names need ``bigint``.
    """
    spark = values.sparkSession
    checkpoint_dir(spark)
    d = values.select(col).where(F.col(col).isNotNull()).distinct()
    # without an explicit count AQE may coalesce the range partitions
    d = d.repartitionByRange(partitions, col) if partitions else d.repartitionByRange(col)
    staged = (d.sortWithinPartitions(col)
              .withColumn("_pid", F.spark_partition_id())
              .withColumn("_pos", F.monotonically_increasing_id()
                          - (F.spark_partition_id().cast("bigint") * F.lit(1 << 33)))
              .persist(StorageLevel.MEMORY_AND_DISK))  # the checkpoint write reads this, not a recompute
    d = staged.checkpoint(eager=True)
    staged.unpersist()
    per = d.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    wp = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, 0)
    offs = per.withColumn("_off", F.sum("_n").over(wp) - F.col("_n")).select("_pid", "_off")
    # offs has one row per range partition: bounded by the partition count
    return (d.join(F.broadcast(offs), "_pid")
            .select(F.col(col), (F.col("_off") + F.col("_pos")).cast(kind).alias(out)))


def row_index(df: DataFrame, out: str = "idx") -> DataFrame:
    """A contiguous 0-based position for every row, assigned once at
    landing (what ``zipWithIndex`` does, on DataFrames).

    Rows keep their partition; each partition's offset comes from a table
    of one row per partition. The rows are pinned first (reliable
    checkpoint) so partition ids and positions cannot change between the
    counting and numbering passes, e.g. after an executor is lost.
    """
    spark = df.sparkSession
    checkpoint_dir(spark)
    staged = (df.withColumn("_pid", F.spark_partition_id())
              .withColumn("_pos", F.monotonically_increasing_id()
                          - (F.spark_partition_id().cast("bigint") * F.lit(1 << 33)))
              .persist(StorageLevel.MEMORY_AND_DISK))
    pinned = staged.checkpoint(eager=True)
    staged.unpersist()
    per = pinned.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    wp = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, 0)
    offs = per.withColumn("_off", F.sum("_n").over(wp) - F.col("_n")).select("_pid", "_off")
    # offs has one row per partition: bounded by the partition count
    return (pinned.join(F.broadcast(offs), "_pid")
            .withColumn(out, (F.col("_off") + F.col("_pos")).cast("bigint"))
            .drop("_pid", "_pos", "_off"))
