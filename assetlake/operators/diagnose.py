"""Class-balance diagnostics.

The class-size table is one aggregation (partial counts per task), so a
class holding a third of all rows costs no more than any other; every
later step works on that table, whose size is the number of classes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from assetlake.operators.quality import DATASET_FLAGS, OUTLOOK, RECOMMENDATIONS


def distribution(df: DataFrame, class_col: str) -> DataFrame:
    """A2: (class, n, pct) with pct = 100 n / total rounded to 1 place."""
    c = df.groupBy(F.col(class_col).alias("class")).agg(F.count(F.lit(1)).cast("bigint").alias("n"))
    total = df.agg(F.count(F.lit(1)).cast("bigint").alias("total")).scalar()
    pct = F.col("n") * F.lit(100.0) / total
    return c.withColumn("pct", F.floor(pct * F.lit(10.0) + F.lit(0.5)) / F.lit(10.0))


def summary(dist: DataFrame) -> DataFrame:
    """A3-A5: total, classes, min, max, ratio, mean, smallest class.

    The smallest class is ``min_by(class, (n, class))``: ties go to the
    first class by name (the surveyed pandas ``idxmin`` takes the first in
    its descending-count order).
    """
    return dist.agg(
        F.sum("n").cast("bigint").alias("total"),
        F.count(F.lit(1)).cast("bigint").alias("classes"),
        F.min("n").cast("bigint").alias("min_n"),
        F.max("n").cast("bigint").alias("max_n"),
        F.min_by("class", F.struct("n", "class")).alias("smallest_class"),
    ).withColumn("ratio", F.col("max_n") / F.col("min_n")).withColumn(
        "mean_per_class", F.col("total") / F.col("classes"))


def flags(summ: DataFrame) -> DataFrame:
    """Q4: one row per flag with whether it fires."""
    stack = ", ".join(f"'{n}', ({e})" for n, e in DATASET_FLAGS)
    return summ.selectExpr(f"stack({len(DATASET_FLAGS)}, {stack}) AS (flag, hit)")


def recommendations(summ: DataFrame, accuracy_col: str | None = None) -> DataFrame:
    """Q6: rule table evaluated against the summary and an accuracy (0 if none is given)."""
    s = summ if accuracy_col else summ.withColumn("accuracy", F.lit(0.0))
    if accuracy_col and accuracy_col != "accuracy":
        s = s.withColumnRenamed(accuracy_col, "accuracy")
    parts = []
    for prio, rule, cond, text in RECOMMENDATIONS:
        parts.append(f"{prio}, '{rule}', coalesce({cond}, false), '{text}'")
    stack = ", ".join(parts)
    return s.selectExpr(f"stack({len(RECOMMENDATIONS)}, {stack}) AS (priority, rule, hit, action)",
                        "total").select(
        "priority", "rule", "hit", "action",
        F.when(F.col("hit") & (F.col("rule") == "collect_more_data"), 1000 - F.col("total")).cast("bigint").alias("need_more"))


def outlook(summ: DataFrame, epochs: int = 3) -> DataFrame:
    """Q6: expected improvements that apply and the realistic targets, one row each."""
    s = summ.withColumn("epochs", F.lit(epochs))
    parts = ", ".join(
        f"'{sec}', '{item}', CASE WHEN {cond} THEN '{yes}' ELSE {'NULL' if no is None else repr(no)} END"
        for sec, item, cond, yes, no in OUTLOOK)
    return s.selectExpr(f"stack({len(OUTLOOK)}, {parts}) AS (section, item, outlook)").where(F.col("outlook").isNotNull())


def first_k_per_group(df: DataFrame, group: str, item: str, k: int = 4) -> DataFrame:
    """The first k items of each group in sorted order, as a list.

    A per-group top-k window (WindowGroupLimit keeps only k rows per group
    in each task before the shuffle), then a list of at most k items.
    """
    w = Window.partitionBy(group).orderBy(item)
    top = df.select(group, item).where(F.col(item).isNotNull()).withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= k)
    return top.groupBy(group).agg(F.array_sort(F.collect_list(item)).alias("first_items"))


def head_rows(df: DataFrame, n: int, order: list[str]) -> DataFrame:
    """The first ``n`` rows in a stated order (a deterministic head; each
    task keeps its own n best before they meet)."""
    return df.orderBy(*order).limit(n)
