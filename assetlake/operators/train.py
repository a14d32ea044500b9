"""Classifier training and batch scoring on the cluster.

The surveyed notebook fine-tunes a deep network on the driver after
collecting every image. Here the model is a Spark ML pipeline over the
per-image statistics (or any vector column): the data never leaves the
executors, training is distributed L-BFGS, and scoring is ``transform``.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import StringIndexer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

STAT_FEATURES = ["mean_rgb", "std_rgb", "brightness", "contrast", "aspect_ratio"]


def feature_vector(df: DataFrame, cols: list[str] | None = None, out: str = "features") -> DataFrame:
    """Flatten array and numeric columns into one ML vector."""
    cols = cols or STAT_FEATURES
    parts = []
    for c in cols:
        dt = df.schema[c].dataType.simpleString()
        parts.append(F.col(c).cast("array<double>") if dt.startswith("array") else F.array(F.col(c).cast("double")))
    return df.withColumn(out, array_to_vector(F.concat(*parts)))


def fit(train: DataFrame, label: str, features: str = "features", max_iter: int = 50,
        reg: float = 0.01) -> PipelineModel:
    """M3: label names -> ids (alphabetical, unseen kept), multinomial LR."""
    idx = StringIndexer(inputCol=label, outputCol="label_id", stringOrderType="alphabetAsc", handleInvalid="keep")
    lr = LogisticRegression(featuresCol=features, labelCol="label_id", family="multinomial",
                            maxIter=max_iter, regParam=reg)
    # the optimiser passes over the data once per iteration: keep it cached
    cached = train.select(label, features).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return Pipeline(stages=[idx, lr]).fit(cached)
    finally:
        cached.unpersist()


def score(model: PipelineModel, df: DataFrame) -> DataFrame:
    """M1: one (label, score) per row: the top class and its probability."""
    labels = model.stages[0].labels
    names = F.array(*[F.lit(x) for x in labels])
    p = model.transform(df)
    probs = vector_to_array("probability")
    top = F.array_max(probs)
    pos = (F.array_position(probs, top) - 1).cast("int")
    return p.withColumn("pred_label", F.when(pos < len(labels), F.get(names, pos))).withColumn("pred_score", top)


# Added to variances, so that a constant component has a finite likelihood.
VARIANCE_FLOOR = 1e-6
VARIANTS = ("means", "gaussian")


def class_profiles(train: DataFrame, label: str, vector: str) -> DataFrame:
    """M3 in closed form: (label, n, mean, var) of each class, one aggregation over the rows."""
    x = train.select(F.col(label).alias("label"), F.posexplode(F.col(vector).cast("array<double>")).alias("i", "x"))
    per = x.groupBy("label", "i").agg(F.count("x").alias("n"), F.avg("x").alias("m"), F.var_pop("x").alias("v"))
    place = F.array_sort(F.collect_list(F.struct("i", "m", "v")))
    return per.groupBy("label").agg(F.max("n").alias("n"), place.alias("p")).select(
        "label", "n", F.col("p.m").alias("mean"), F.col("p.v").alias("var"))


def profile_scores(rows: DataFrame, profiles: DataFrame, vector: str) -> DataFrame:
    """M1: for both variants the best class of each row and its share (softmax over the classes).

    ``means`` scores by the squared distance to the class mean, ``gaussian`` by the likelihood under
    independent normal components. The profiles, one per class, come in as one scalar value: the rows
    aren't joined, shuffled or repeated. Ties go to the first class by name.
    """
    model = profiles.agg(F.array_sort(F.collect_list(F.struct("label", "n", "mean", "var"))).alias("m")).scalar()
    t = rows.withColumn("_m", model).withColumn("_x", F.col(vector).cast("array<double>"))
    total = F.aggregate("_m", F.lit(0).cast("bigint"), lambda s, c: s + c["n"])

    def summed(parts):
        return F.aggregate(parts, F.lit(0.0), lambda s, v: s + v)

    def square(c):
        return F.zip_with("_x", c["mean"], lambda x, m: (x - m) * (x - m))

    def likelihood(c):
        floor = F.lit(VARIANCE_FLOOR)
        parts = F.zip_with(square(c), c["var"], lambda d, v: F.ln(v + floor) + d / (v + floor))
        return F.ln(c["n"] / total) - F.lit(0.5) * summed(parts)

    def best(of, top):
        first = F.get(F.filter(of, lambda e: e["s"] == top), F.lit(0))
        share = 1.0 / summed(F.transform(of, lambda e: F.exp(e["s"] - top)))
        return F.struct(first["label"].alias("label"), share.alias("score"))

    def valued(score):
        return F.transform("_m", lambda c: F.struct(score(c).alias("s"), c["label"].alias("label")))

    for name, score in zip(VARIANTS, (lambda c: -summed(square(c)), likelihood)):
        t = t.withColumn(f"_{name}", valued(score))
        t = t.withColumn(name, best(F.col(f"_{name}"), F.array_max(F.transform(f"_{name}", lambda e: e["s"]))))
    return t.drop("_m", "_x", *[f"_{v}" for v in VARIANTS])


def choose(scored: DataFrame, label: str, validation) -> DataFrame:
    """M3: the variant with more hits on the validation rows (the first on ties), for the other rows."""
    hits = [F.count_if(F.col(f"{v}.label").eqNullSafe(F.col(label))).alias(v) for v in VARIANTS]
    a, b = VARIANTS
    best = scored.where(validation).agg(*hits).select(F.when(F.col(b) > F.col(a), b).otherwise(a)).scalar()
    t = scored.where(~validation).withColumn("variant", best)
    picked = F.when(F.col("variant") == b, F.col(b)).otherwise(F.col(a))
    return t.withColumn("pred_label", picked["label"]).withColumn("pred_score", picked["score"]).drop(*VARIANTS)


def save(model: PipelineModel, path: str) -> None:
    """Model files (the registry row is a table written by the caller)."""
    model.write().overwrite().save(path)
