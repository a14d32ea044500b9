"""Helpers shared by the operators of this package."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import time
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from assetlake.session import checkpoint_dir

#: White space that separates words (space, tab to carriage return).
SPACES = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a Parquet table in the cluster's shared checkpoint folder and read it back.

    Cuts the lineage: a lost executor costs the stages after the table only. Each call writes a
    folder of its own, so nothing written before is read or overwritten.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/assetlake-llm/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_or_empty(col: str = "text") -> Column:
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def word_count(text: Column) -> Column:
    """Number of words of a text, null counting as empty."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def with_text(docs: DataFrame, text: Column, prefix: str = "") -> list[Column]:
    """The columns of ``docs`` with another text, and its length where they have ``n_chars``."""
    put = {"text": text, "n_chars": F.length(text).cast("long")}
    return [put[c].alias(c) if c in put else F.col(f"{prefix}`{c}`") for c in docs.columns]


def input_splits(df: DataFrame) -> int:
    """Number of read tasks: what shuffles of packed blocks are sized by, so that they grow with the input."""
    return max(1, df.rdd.getNumPartitions())


def release(spark: SparkSession) -> None:
    """Let Spark's cleaner drop the shuffle files of finished stages now.

    It drops them when the driver collects its garbage, which an idle driver does too late for the
    executors' disks. Called after a stage's table is written, when its shuffles aren't needed again.
    Twice: the gateway lets go of what Python has dropped only between two collections.
    """
    for _ in range(2):
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.3)


def give_back() -> None:
    """Hand freed memory that Arrow and the C library keep for reuse to the system.

    Python workers outlive their tasks, so what they keep stands beside the tasks after them.
    """
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(AttributeError, OSError):  # a C library without it
        ctypes.CDLL(None).malloc_trim(0)


@contextlib.contextmanager
def small_batches(spark: SparkSession, size: int) -> Iterator[None]:
    """Meanwhile Spark hands Python about ``size`` bytes at a time, unless the session says how many.

    Rows of texts differ much in length, so 10,000 of them can be any amount, once in the executor
    and once in its worker.
    """
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key, None) is not None:
        yield
        return
    spark.conf.set(key, str(size))
    try:
        yield
    finally:
        spark.conf.unset(key)
