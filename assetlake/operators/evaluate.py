"""Evaluation.

Everything is computed from the confusion table (truth, pred, n): one
partial+final aggregation over the scored rows, after which the data is at
most classes^2 rows. No sample is drawn: the caller passes the held-out
split, so the surveyed report's leakage (sampling from training rows) does
not happen here.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assetlake.session import checkpoint_dir

LOW_ACCURACY = 0.5   # fixed value: classes below this are listed
LOG_EPS = 1e-15


def confusion(df: DataFrame, truth: str, pred: str) -> DataFrame:
    """(truth, pred, n): counts of every (true, predicted) pair present."""
    return df.groupBy(F.col(truth).alias("truth"), F.col(pred).alias("pred")).agg(
        F.count(F.lit(1)).cast("bigint").alias("n"))


def accuracy(df: DataFrame, truth: str, pred: str) -> DataFrame:
    """(correct, total, accuracy) in one row."""
    hit = F.col(truth).eqNullSafe(F.col(pred))
    return df.agg(F.count_if(hit).cast("bigint").alias("correct"),
                  F.count(F.lit(1)).cast("bigint").alias("total")).withColumn(
        "accuracy", F.when(F.col("total") > 0, F.col("correct") / F.col("total")))


def per_class(df: DataFrame, truth: str, pred: str, classes: DataFrame | None = None) -> DataFrame:
    """Per true class (correct, total, accuracy); classes without rows kept
    with total 0 and null accuracy ('no samples') when a class list is given."""
    g = df.groupBy(F.col(truth).alias("class")).agg(
        F.count_if(F.col(truth).eqNullSafe(F.col(pred))).cast("bigint").alias("correct"),
        F.count(F.lit(1)).cast("bigint").alias("total"))
    if classes is not None:
        g = classes.select(F.col(classes.columns[0]).alias("class")).distinct().join(g, "class", "left")
        g = g.select("class", F.coalesce("correct", F.lit(0)).cast("bigint").alias("correct"),
                     F.coalesce("total", F.lit(0)).cast("bigint").alias("total"))
    return g.withColumn("accuracy", F.when(F.col("total") > 0, F.col("correct") / F.col("total")))


def low_classes(per: DataFrame, threshold: float = LOW_ACCURACY) -> DataFrame:
    """Classes with samples whose accuracy is below the threshold."""
    return per.filter((F.col("total") > 0) & (F.col("accuracy") < F.lit(threshold)))


def f1_by_class(conf: DataFrame) -> DataFrame:
    """(class, support, predicted, tp, f1) from a confusion table."""
    by_truth = conf.groupBy(F.col("truth").alias("class")).agg(
        F.sum("n").alias("support"),
        F.sum(F.when(F.col("truth").eqNullSafe(F.col("pred")), F.col("n")).otherwise(0)).alias("tp"))
    by_pred = conf.groupBy(F.col("pred").alias("class")).agg(F.sum("n").alias("predicted"))
    j = by_truth.join(by_pred, "class", "full_outer")
    s = F.coalesce("support", F.lit(0))
    q = F.coalesce("predicted", F.lit(0))
    tp = F.coalesce("tp", F.lit(0))
    return j.select("class", s.cast("bigint").alias("support"), q.cast("bigint").alias("predicted"),
                    tp.cast("bigint").alias("tp"),
                    F.when(s + q > 0, F.lit(2.0) * tp / (s + q)).otherwise(F.lit(0.0)).alias("f1"))


def weighted_f1(df: DataFrame, truth: str, pred: str) -> DataFrame:
    """A10: F1 per class weighted by true support (0 when p+r = 0).

    The confusion table is read twice (by truth and by prediction); it is
    pinned first so the scored rows are scanned once."""
    checkpoint_dir(df.sparkSession)
    f = f1_by_class(confusion(df, truth, pred).checkpoint(eager=True))
    return f.agg((F.sum(F.col("f1") * F.col("support")) / F.sum("support")).alias("weighted_f1"),
                 F.sum("support").cast("bigint").alias("total"))


def log_loss(df: DataFrame, p_true: str) -> DataFrame:
    """Mean of -ln(p of the true class), clipped away from 0 and 1."""
    p = F.least(F.greatest(F.col(p_true), F.lit(LOG_EPS)), F.lit(1.0 - LOG_EPS))
    return df.agg(F.avg(-F.ln(p)).alias("log_loss"), F.count(F.lit(1)).cast("bigint").alias("total"))


def argmax(arr) -> F.Column:
    """0-based position of the first maximum of an array."""
    a = F.col(arr) if isinstance(arr, str) else arr
    return (F.array_position(a, F.array_max(a)) - 1).cast("int")


def report(scored: DataFrame, truth: str, pred: str, classes: DataFrame | None = None) -> dict[str, DataFrame]:
    """M7: the evaluation report on a held-out set: overall accuracy,
    per-class accuracy (classes without samples kept), low classes,
    weighted F1. Pass the held-out split: nothing is sampled here."""
    per = per_class(scored, truth, pred, classes)
    return {"accuracy": accuracy(scored, truth, pred), "per_class": per,
            "low_classes": low_classes(per), "weighted_f1": weighted_f1(scored, truth, pred)}


def run_metrics(df: DataFrame, truth: str, pred: str, p_true: str | None = None) -> list[DataFrame]:
    """Accuracy, weighted F1, log loss and row count from ONE pass over the
    scored rows: a confusion table that also sums -ln p per (truth, pred)
    cell; everything else is arithmetic on that table (classes^2 rows).
    Returns one-row frames for ``sinks.tables.metric_rows``. Runs the pass
    eagerly (the table is checkpointed)."""
    aggs = [F.count(F.lit(1)).alias("n")]
    if p_true is not None:
        p = F.least(F.greatest(F.col(p_true), F.lit(LOG_EPS)), F.lit(1.0 - LOG_EPS))
        aggs.append(F.sum(-F.ln(p)).alias("nll"))
    conf = df.groupBy(F.col(truth).alias("truth"), F.col(pred).alias("pred")).agg(*aggs)
    # The table is tiny (classes^2 rows) and read by every metric: pin it
    # (reliable checkpoint in spark.checkpoint.dir) so the scored rows are
    # scanned once instead of once per metric.
    checkpoint_dir(df.sparkSession)
    conf = conf.checkpoint(eager=True)
    hit = F.col("truth").eqNullSafe(F.col("pred"))
    tot = [F.sum("n").alias("_n"), F.sum(F.when(hit, F.col("n")).otherwise(0)).alias("_hit")]
    if p_true is not None:
        tot.append(F.sum("nll").alias("_nll"))
    t = conf.agg(*tot)
    cols = [(F.col("_hit") / F.col("_n")).alias("accuracy"), F.col("_n").cast("bigint").alias("total")]
    if p_true is not None:
        cols.append((F.col("_nll") / F.col("_n")).alias("log_loss"))
    f = f1_by_class(conf.select("truth", "pred", "n"))
    f1 = f.agg((F.sum(F.col("f1") * F.col("support")) / F.sum("support")).alias("weighted_f1"))
    return [t.select(*cols), f1]
