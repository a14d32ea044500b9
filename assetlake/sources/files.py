"""File sources: binary files (batch and stream) and decoded images.

Schemas are explicit: Spark's streaming ``binaryFile`` source requires one,
and it keeps the schema stable across runs (the role of a schema location).
Every file row carries ``source_file`` (``_metadata.file_path``), the join
key between the bytes scan and the decoded-image scan; ``path`` and the
image ``origin`` spell the same file differently (``file:/`` vs
``file:///``, spaces vs ``%20``), ``_metadata.file_path`` does not.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BINARY_SCHEMA = T.StructType([
    T.StructField("path", T.StringType(), False),
    T.StructField("modificationTime", T.TimestampType(), False),
    T.StructField("length", T.LongType(), False),
    T.StructField("content", T.BinaryType(), True),
])
MAX_FILES_PER_TRIGGER = 100   # fixed value of the surveyed stream


def binary_files(spark: SparkSession, root: str, glob: str | None = None) -> DataFrame:
    """Batch scan of every file under ``root`` (recursively)."""
    r = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        r = r.option("pathGlobFilter", glob)
    return r.load(root).withColumn("source_file", F.col("_metadata.file_path"))


def binary_stream(spark: SparkSession, root: str, max_files: int = MAX_FILES_PER_TRIGGER,
                  glob: str | None = None) -> DataFrame:
    """Streaming scan; each file is read once (the source's file
    log in the checkpoint remembers it, so an overwrite is not re-read), at
    most ``max_files`` per micro-batch."""
    r = (spark.readStream.format("binaryFile").schema(BINARY_SCHEMA)
         .option("maxFilesPerTrigger", str(max_files))
         .option("recursiveFileLookup", "true"))
    if glob:
        r = r.option("pathGlobFilter", glob)
    return r.load(root).withColumn("source_file", F.col("_metadata.file_path"))


def decoded_images(spark: SparkSession, root: str) -> DataFrame:
    """Decoded pixels of every image under ``root``.

    Undecodable files are kept as rows with negative sizes (``dropInvalid``
    false), so they count as failed processing rather than vanishing.
    """
    return (spark.read.format("image").option("dropInvalid", "false")
            .option("recursiveFileLookup", "true").load(root)
            .select(F.col("_metadata.file_path").alias("source_file"), F.col("image")))
