"""Dataset splits and sampling.

The default split draws u from a hash of (seed, id), so the assignment of a
row does not depend on partitioning, retries or the run; the ``rand`` form
is kept for parity with the surveyed pipeline.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assetlake.operators.rank import FINE_BUCKETS, first_k, unit_hash

# Fixed values of the surveyed pipeline: u < 0.70 train, < 0.85 validation.
TRAIN_SHARE = 0.70
VALIDATION_EDGE = 0.85
DEFAULT_SEED = 42


def split_label(u: Column, train: float = TRAIN_SHARE, validation_edge: float = VALIDATION_EDGE) -> Column:
    return (F.when(u < F.lit(train), F.lit("train"))
            .when(u < F.lit(validation_edge), F.lit("validation"))
            .otherwise(F.lit("test")))


def split_hash(df: DataFrame, id_col: str, seed: int = DEFAULT_SEED,
               u_col: str = "split_seed", out: str = "dataset_split") -> DataFrame:
    """D2 (default): repeatable three-way split from md5(seed:id)."""
    return df.withColumn(u_col, unit_hash(seed, id_col)).withColumn(out, split_label(F.col(u_col)))


def split_rand(df: DataFrame, seed: int = DEFAULT_SEED,
               u_col: str = "split_seed", out: str = "dataset_split") -> DataFrame:
    """D2 as written in the surveyed pipeline: ``rand(seed)``.

    Values depend on the input partitioning, so re-runs on a re-laid-out
    table move rows between splits; prefer ``split_hash``.
    """
    return df.withColumn(u_col, F.rand(seed)).withColumn(out, split_label(F.col(u_col)))


def split_stratified(df: DataFrame, class_col: str, id_col: str, seed: int = DEFAULT_SEED,
                     out: str = "dataset_split") -> DataFrame:
    """D3: the same thresholds applied to each row's position inside its class.

    q = (rows of the class ordered before this row's (u, id) key) / n_class,
    u = md5(seed:id). Copies of one id share a key, hence one split: a
    duplicate never lands on both sides of a train/test boundary.

    Rows are first collapsed to distinct keys with counts (partial
    aggregation, so a key held by a third of all rows shuffles one row per
    task). A key's position is its (class, bucket) cell offset -- from a
    per-class histogram of at most 65,536 cells -- plus a running count over
    the distinct keys of its cell, so no window ever holds a whole class.
    The per-key result joins back on the key; AQE splits a skewed key's
    partition on the row side.
    """
    t = df.withColumn("_u", unit_hash(seed, id_col)).withColumn("_b", F.floor(F.col("_u") * FINE_BUCKETS).cast("int"))
    keys = t.groupBy(class_col, "_b", "_u", id_col).agg(F.count(F.lit(1)).alias("_c"))
    hist = keys.groupBy(class_col, "_b").agg(F.sum("_c").alias("_n"))
    wc = Window.partitionBy(class_col).orderBy("_b").rowsBetween(Window.unboundedPreceding, 0)
    offs = (hist.withColumn("_before", F.sum("_n").over(wc) - F.col("_n"))
            .withColumn("_total", F.sum("_n").over(Window.partitionBy(class_col)))
            .select(F.col(class_col).alias("_oc"), F.col("_b").alias("_ob"), "_before", "_total"))
    wk = Window.partitionBy(class_col, "_b").orderBy("_u", id_col).rowsBetween(Window.unboundedPreceding, 0)
    ranked = (keys.withColumn("_in_cell", F.sum("_c").over(wk) - F.col("_c"))
              .join(offs, F.col(class_col).eqNullSafe(F.col("_oc")) & (F.col("_b") == F.col("_ob")))
              .withColumn("_q", (F.col("_before") + F.col("_in_cell")) / F.col("_total"))
              .select(F.col(class_col).alias("_kc"), F.col("_b").alias("_kb"), F.col("_u").alias("_ku"),
                      F.col(id_col).alias("_kid"), split_label(F.col("_q")).alias(out)))
    # null-safe on the class and id so rows with null keys keep their split
    cond = (F.col(class_col).eqNullSafe(F.col("_kc")) & (F.col("_b") == F.col("_kb"))
            & F.col("_u").eqNullSafe(F.col("_ku")) & F.col(id_col).eqNullSafe(F.col("_kid")))
    return t.join(ranked, cond).select(*df.columns, out)


def test_count(n: int, test_size: float) -> int:
    """Rows in the test side of an exact two-way split: ceil(n * share)."""
    import math
    return int(math.ceil(n * test_size - 1e-9))


def train_test_exact(df: DataFrame, id_col: str, test_size: float = 0.2, seed: int = DEFAULT_SEED,
                     out: str = "split", total: int | None = None) -> DataFrame:
    """Exactly ceil(test_size * n) rows are 'test', the first by (u, id)."""
    n = total if total is not None else df.count()
    k = test_count(n, test_size)
    t = df.withColumn("_u", unit_hash(seed, id_col))
    flagged = first_k(t, "_u", [id_col], k, out="_in")
    return flagged.withColumn(out, F.when(F.col("_in"), F.lit("test")).otherwise(F.lit("train"))).drop("_u", "_in")


def sample_n(df: DataFrame, id_col: str, n: int, seed: int = DEFAULT_SEED) -> DataFrame:
    """Exactly min(n, rows) rows, repeatable: the n smallest md5(seed:id).

    ``orderBy().limit()`` plans as TakeOrderedAndProject: every partition
    keeps its own n best, and only n x partitions rows meet in the last task.
    """
    return (df.withColumn("_u", unit_hash(seed, id_col))
            .orderBy("_u", id_col).limit(n).drop("_u"))
