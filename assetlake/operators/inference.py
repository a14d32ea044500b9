"""Batch inference over normalised tensors (M1, I4).

``predict_batch_udf`` hands each worker its rows as arrays, and a worker builds its model once: the
weights are loaded by the first batch and kept. Normalisation is part of the model, as the surveyed
scoring does it before the forward pass.

Defined results: a null or short vector has a null label and score; of equal classes the first wins.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.ml.functions import predict_batch_udf
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BATCH = 4096


def normalised(x: np.ndarray, mean: np.ndarray, std: np.ndarray, scale: float = 1.0) -> np.ndarray:
    """I4 on rows of values: (x / scale - mean) / std."""
    return (x / scale - mean) / std


def classifier(load: Callable[[], tuple[np.ndarray, list[str]]], width: int, mean: float | list[float] = 0.0, std: float | list[float] = 1.0,
               scale: float = 1.0) -> Callable[[Column], Column]:
    """A function of a vector column that gives the class probabilities.

    ``load`` returns (weights with a last column of constants, class names); it runs once a worker.
    """
    centre, spread = np.broadcast_to(np.asarray(mean, float), width), np.broadcast_to(np.asarray(std, float), width)

    def make():
        weights, _ = load()

        def predict(x: np.ndarray) -> np.ndarray:
            z = normalised(x.astype(float), centre, spread, scale) @ weights[:, :-1].T + weights[:, -1]
            z = np.exp(z - z.max(1, keepdims=True))
            return z / z.sum(1, keepdims=True)

        return predict

    return predict_batch_udf(make, return_type=T.ArrayType(T.DoubleType()), batch_size=BATCH, input_tensor_shapes=[[width]])


def score(df: DataFrame, vector: str, model: Callable[[Column], Column], names: list[str], width: int) -> DataFrame:
    """M1: pred_label and pred_score of every row."""
    whole = (F.size(vector) == width) & ~F.exists(vector, lambda v: v.isNull())
    usable = F.when(whole, F.col(vector).cast("array<double>")).otherwise(F.array_repeat(F.lit(0.0), width))
    d = df.withColumn("_p", model(usable)).withColumn("_ok", F.coalesce(whole, F.lit(False)))
    top = F.array_max("_p")
    label = F.element_at(F.array(*map(F.lit, names)), F.array_position("_p", top).cast("int"))
    return d.withColumn("pred_label", F.when(F.col("_ok"), label)).withColumn("pred_score", F.when(F.col("_ok"), top)).drop("_p", "_ok")
