"""Training by epochs with the best epoch kept by evaluation loss (M3).

Softmax regression with weight decay. An epoch is one pass over the rows: every task adds up the
gradient of its training rows and the losses of its training and evaluation rows under the epoch's
weights, and one small aggregation adds the tasks' sums. Weights (classes x components, sent to all
tasks) are written after every epoch, so a stopped run goes on from its last one, and the epoch of
least evaluation loss is the model.

Defined results: rows with a null label, one outside ``classes``, or a null, short, long or non-finite
vector take no part; without evaluation rows the last epoch is chosen; of equal losses the first.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TRAIN, EVALUATION = "train", "validation"
WEIGHTS = "epoch int, class string, weights array<double>"
_SUMS = "kind string, class int, place int, value double"


@dataclass(frozen=True)
class Settings:
    # Fixed values of the surveyed training arguments: epochs and weight decay.
    epochs: int = 3
    decay: float = 0.01
    rate: float = 1.0


def usable(rows: DataFrame, label: str, vector: str, classes: list[str], width: int) -> DataFrame:
    """y (place of the label in ``classes``), x and split of the rows that take part."""
    table = F.create_map(*[F.lit(x) for pair in ((c, i) for i, c in enumerate(classes)) for x in pair])
    d = rows.select(F.try_element_at(table, F.col(label).cast("string")).alias("y"), F.col(vector).cast("array<double>").alias("x"), "split")
    bad = F.exists("x", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return d.where(F.col("y").isNotNull() & (F.size("x") == width) & ~bad & F.col("split").isin(TRAIN, EVALUATION))


def probabilities(x: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Softmax of the rows of ``x`` (with a last column of ones) for each class."""
    z = x @ weights.T
    z = np.exp(z - z.max(1, keepdims=True))
    return z / z.sum(1, keepdims=True)


def _pass(weights):
    """Sums of a task: gradient by class and component, losses and rows by kind."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = weights.value
        gradient, loss, n = np.zeros_like(w), [0.0, 0.0], [0, 0]
        for batch in batches:
            if not batch.num_rows:
                continue
            y = batch.column("y").to_numpy()
            x = np.hstack([batch.column("x").flatten().to_numpy().reshape(len(y), -1), np.ones((len(y), 1))])
            p = probabilities(x, w)
            held = np.array(batch.column("split").to_pylist()) == EVALUATION
            losses = -np.log(p[np.arange(len(y)), y])
            for k, part in enumerate((~held, held)):
                loss[k] += float(losses[part].sum())
                n[k] += int(part.sum())
            p[np.arange(len(y)), y] -= 1
            gradient += p[~held].T @ x[~held]
        rows = [("loss", None, k, v) for k, v in enumerate(loss)] + [("rows", None, k, float(v)) for k, v in enumerate(n)]
        rows += [("gradient", c, j, float(gradient[c, j])) for c in range(w.shape[0]) for j in range(w.shape[1])]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.string(), pa.int32(), pa.int32(), pa.float64()))],
                                         names=["kind", "class", "place", "value"])

    return run


def run_epochs(rows: DataFrame, label: str, vector: str, classes: list[str], width: int, path: str, settings: Settings = Settings()) -> DataFrame:
    """Train and return the history: epoch, train_loss, eval_loss and chosen.

    ``rows`` have a column ``split``. Epoch e's losses are those of the weights after e epochs (0: all
    zero, the start). Weights are written to ``path``/epoch=e; a run over a path that has some goes on
    behind the last of them.
    """
    spark = rows.sparkSession
    data = usable(rows, label, vector, classes, width).persist()
    history = []
    try:
        weights = np.zeros((len(classes), width + 1))
        for epoch in range(settings.epochs + 1):
            stored = None if epoch == 0 else _stored(spark, path, epoch, classes)
            if stored is not None:
                weights = stored
            elif epoch:
                decay = settings.decay * weights
                decay[:, -1] = 0.0  # no decay of the constant, as usual
                weights = weights - settings.rate * (gradient / max(1.0, n[0]) + decay)
                spark.createDataFrame([(epoch, c, w) for c, w in zip(classes, weights.tolist())], WEIGHTS).coalesce(1).write.mode("overwrite").parquet(f"{path}/epoch={epoch}")
            gradient, loss, n = _sums(spark, data, weights)
            history.append((epoch, *(loss[k] / n[k] if n[k] else None for k in (0, 1))))
    finally:
        data.unpersist()
    losses = [e for _, _, e in history]
    best = len(losses) - 1 if losses[0] is None else losses.index(min(losses))
    return spark.createDataFrame([(*h, h[0] == best) for h in history], "epoch int, train_loss double, eval_loss double, chosen boolean")


def _sums(spark: SparkSession, data: DataFrame, weights: np.ndarray) -> tuple[np.ndarray, list[float], list[float]]:
    sent = spark.sparkContext.broadcast(weights)
    gradient, loss, n = np.zeros_like(weights), [0.0, 0.0], [0.0, 0.0]
    total = data.mapInArrow(_pass(sent), _SUMS).groupBy("kind", "class", "place").agg(F.sum("value").alias("value"))
    for r in total.collect():  # as many as the model has weights
        if r["kind"] == "gradient":
            gradient[r["class"], r["place"]] = r["value"]
        else:
            (loss if r["kind"] == "loss" else n)[r["place"]] = r["value"]
    return gradient, loss, n


def _stored(spark: SparkSession, path: str, epoch: int, classes: list[str]) -> np.ndarray | None:
    from pyspark.errors import AnalysisException
    try:
        rows = {r["class"]: r["weights"] for r in spark.read.schema(WEIGHTS).parquet(f"{path}/epoch={epoch}").collect()}
    except AnalysisException:
        return None
    return np.array([rows[c] for c in classes]) if set(rows) == set(classes) else None


def best_weights(spark: SparkSession, path: str, history: DataFrame, classes: list[str]) -> np.ndarray:
    """Weights of the chosen epoch: one row a class, the last column its constant."""
    epoch = history.where("chosen").first()["epoch"]
    width = len(_stored(spark, path, 1, classes)[0]) if epoch == 0 else 0
    return np.zeros((len(classes), width)) if epoch == 0 else _stored(spark, path, epoch, classes)
