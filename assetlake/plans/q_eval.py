"""Evaluation queries: labels give truth (quality) and a prediction (1 - toxic);
a predicted-class probability is derived from the document id."""

from __future__ import annotations

from pyspark.sql import functions as F

from assetlake.functions.columns import round6
from assetlake.operators import evaluate as V
from assetlake.operators.quality import accuracy_band, loss_note
from assetlake.plans.registry import r6, register
from assetlake.sinks.tables import metric_rows
from assetlake.sources.tables import read_table

CLASSES = [0, 1, 2]   # class list from config; class 2 has no samples


def _scored(spark, d):
    lab = read_table(spark, d, "labels")
    score = F.lit(0.05) + F.lit(0.9) * ((F.col("doc_id") * 37) % 100) / F.lit(100.0)
    return lab.select("doc_id", F.col("quality").alias("truth"), (F.lit(1) - F.col("toxic")).alias("pred"),
                      score.alias("score")).withColumn(
        "p_true", F.when(F.col("truth") == F.col("pred"), F.col("score")).otherwise(F.lit(1.0) - F.col("score")))


_SCORED_SQL = """sc AS (SELECT doc_id, quality AS truth, 1 - toxic AS pred,
       0.05::DOUBLE + 0.9::DOUBLE * ((doc_id * 37) % 100) / 100.0::DOUBLE AS score FROM labels),
sp AS (SELECT *, CASE WHEN truth = pred THEN score ELSE 1.0::DOUBLE - score END AS p_true FROM sc)"""


def confusion(spark, d):
    return V.confusion(_scored(spark, d), "truth", "pred")


register("confusion", f"""WITH {_SCORED_SQL}
SELECT truth, pred, CAST(count(*) AS BIGINT) AS n FROM sp GROUP BY truth, pred
""")(confusion)


def accuracy(spark, d):
    a = V.accuracy(_scored(spark, d), "truth", "pred")
    return a.select("correct", "total", round6("accuracy").alias("accuracy"))


register("accuracy", f"""WITH {_SCORED_SQL}
SELECT CAST(count(*) FILTER (WHERE truth IS NOT DISTINCT FROM pred) AS BIGINT) AS correct,
       CAST(count(*) AS BIGINT) AS total,
       {r6('count(*) FILTER (WHERE truth IS NOT DISTINCT FROM pred)::DOUBLE / count(*)')} AS accuracy
FROM sp
""")(accuracy)


def per_class_accuracy(spark, d):
    classes = spark.createDataFrame([(c,) for c in CLASSES], "class int")
    p = V.per_class(_scored(spark, d), "truth", "pred", classes)
    return p.select("class", "correct", "total", round6("accuracy").alias("accuracy"))


_classes_sql = ", ".join(f"({c})" for c in CLASSES)
_PER_CLASS_SQL = f"""{_SCORED_SQL},
cl(class) AS (VALUES {_classes_sql}),
g AS (SELECT truth AS class, count(*) FILTER (WHERE truth IS NOT DISTINCT FROM pred) AS correct,
             count(*) AS total FROM sp GROUP BY truth),
pc AS (SELECT CAST(cl.class AS INTEGER) AS class, CAST(coalesce(g.correct, 0) AS BIGINT) AS correct,
              CAST(coalesce(g.total, 0) AS BIGINT) AS total FROM cl LEFT JOIN g ON cl.class = g.class)"""

register("per_class_accuracy", f"""WITH {_PER_CLASS_SQL}
SELECT class, correct, total, CASE WHEN total > 0 THEN {r6('correct::DOUBLE / total')} END AS accuracy FROM pc
""")(per_class_accuracy)


def low_classes(spark, d):
    classes = spark.createDataFrame([(c,) for c in CLASSES], "class int")
    low = V.low_classes(V.per_class(_scored(spark, d), "truth", "pred", classes))
    return low.select("class", round6("accuracy").alias("accuracy"))


register("low_classes", f"""WITH {_PER_CLASS_SQL}
SELECT class, {r6('correct::DOUBLE / total')} AS accuracy FROM pc
WHERE total > 0 AND correct::DOUBLE / total < 0.5
""")(low_classes)


def weighted_f1(spark, d):
    w = V.weighted_f1(_scored(spark, d), "truth", "pred")
    return w.select(round6("weighted_f1").alias("weighted_f1"), "total")


_F1_SQL = f"""{_SCORED_SQL},
cf AS (SELECT truth, pred, count(*) AS n FROM sp GROUP BY truth, pred),
bt AS (SELECT truth AS class, sum(n) AS support, sum(CASE WHEN truth IS NOT DISTINCT FROM pred THEN n ELSE 0 END) AS tp
       FROM cf GROUP BY truth),
bp AS (SELECT pred AS class, sum(n) AS predicted FROM cf GROUP BY pred),
f AS (SELECT coalesce(bt.support, 0) AS s, coalesce(bp.predicted, 0) AS q, coalesce(bt.tp, 0) AS tp
      FROM bt FULL OUTER JOIN bp ON bt.class = bp.class),
ff AS (SELECT s, CASE WHEN s + q > 0 THEN 2.0::DOUBLE * tp / (s + q) ELSE 0.0::DOUBLE END AS f1 FROM f)"""

register("weighted_f1", f"""WITH {_F1_SQL}
SELECT {r6('sum(f1 * s) / sum(s)')} AS weighted_f1, CAST(sum(s) AS BIGINT) AS total FROM ff
""")(weighted_f1)


def log_loss(spark, d):
    ll = V.log_loss(_scored(spark, d), "p_true")
    return ll.select(round6("log_loss").alias("log_loss"), "total")


register("log_loss", f"""WITH {_SCORED_SQL}
SELECT {r6('avg(-ln(least(greatest(p_true, 1e-15::DOUBLE), 1.0::DOUBLE - 1e-15::DOUBLE)))')} AS log_loss,
       CAST(count(*) AS BIGINT) AS total FROM sp
""")(log_loss)


def metric_band(spark, d):
    """Accuracy and loss per document language, with their bands (join of
    labels with documents on doc_id: a shuffle join sized by the smaller
    labels side, broadcast by AQE when it is small)."""
    sc = _scored(spark, d)
    docs = read_table(spark, d, "documents").select("doc_id", "lang")
    j = sc.join(docs, "doc_id")
    hit = F.col("truth").eqNullSafe(F.col("pred"))
    p = F.least(F.greatest(F.col("p_true"), F.lit(1e-15)), F.lit(1.0 - 1e-15))
    g = j.groupBy("lang").agg((F.count_if(hit) / F.count(F.lit(1))).alias("acc"),
                              F.avg(-F.ln(p)).alias("loss"),
                              F.count(F.lit(1)).cast("bigint").alias("n"))
    return g.select("lang", "n", round6("acc").alias("accuracy"), accuracy_band(F.col("acc")).alias("band"),
                    round6("loss").alias("log_loss"), loss_note(F.col("loss")).alias("loss_note"))


register("metric_band", f"""WITH {_SCORED_SQL},
g AS (SELECT lang, count(*) FILTER (WHERE truth IS NOT DISTINCT FROM pred)::DOUBLE / count(*) AS acc,
             avg(-ln(least(greatest(p_true, 1e-15::DOUBLE), 1.0::DOUBLE - 1e-15::DOUBLE))) AS loss,
             CAST(count(*) AS BIGINT) AS n
      FROM sp JOIN documents USING (doc_id) GROUP BY lang)
SELECT lang, n, {r6('acc')} AS accuracy,
       CASE WHEN acc < 0.3 THEN 'critical' WHEN acc < 0.5 THEN 'poor' WHEN acc < 0.7 THEN 'fair'
            WHEN acc < 0.85 THEN 'good' ELSE 'excellent' END AS band,
       {r6('loss')} AS log_loss,
       CASE WHEN loss > 2.0 THEN 'high' WHEN loss < 0.1 THEN 'very_low' ELSE 'normal' END AS loss_note
FROM g
""")(metric_band)


# Training parameters logged with every run (fixed values of the surveyed run).
RUN_PARAMS = {"epochs": "5", "batch_size": "12", "learning_rate": "2e-4", "weight_decay": "0.01", "seed": "42"}


def run_log(spark, d):
    sc = _scored(spark, d)
    frames = V.run_metrics(sc, "truth", "pred", "p_true")
    text_metric = frames[0].select(F.lit("1").alias("best_class"))  # not numeric: dropped by metric_rows
    rows = metric_rows(frames + [text_metric], RUN_PARAMS)
    return rows.select("kind", "name", round6("value").alias("value"), "text")


register("run_log", f"""WITH {_F1_SQL},
a AS (SELECT count(*) FILTER (WHERE truth IS NOT DISTINCT FROM pred)::DOUBLE / count(*) AS accuracy,
             avg(-ln(least(greatest(p_true, 1e-15::DOUBLE), 1.0::DOUBLE - 1e-15::DOUBLE))) AS log_loss,
             count(*)::DOUBLE AS total FROM sp),
w AS (SELECT sum(f1 * s) / sum(s) AS weighted_f1 FROM ff)
SELECT 'metric' AS kind, 'accuracy' AS name, {r6('accuracy')} AS value, CAST(NULL AS VARCHAR) AS text FROM a
UNION ALL SELECT 'metric', 'weighted_f1', {r6('weighted_f1')}, NULL FROM w
UNION ALL SELECT 'metric', 'total', {r6('total')}, NULL FROM a
UNION ALL SELECT 'metric', 'log_loss', {r6('log_loss')}, NULL FROM a
""" + "".join(f"UNION ALL SELECT 'param', '{k}', NULL, '{v}'\n" for k, v in RUN_PARAMS.items()))(run_log)
