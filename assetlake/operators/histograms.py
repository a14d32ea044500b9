"""Picture statistics from byte histograms.

A channel is its 256 counts. Counts of parts of one picture, or of many pictures, add up, and mean,
population deviation, brightness and contrast follow exactly from whole-number sums over the cells,
whatever the order. Taking the counts and their moments are vectorised passes in the scan task; adding
histograms is a plain aggregation with map-side partial sums; the statistics are Column expressions.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assetlake.operators.images import luma, quality_score

CELLS = 256
GRAY = ["gray"]
COLOUR = ["red", "green", "blue", "luma"]
STRIP = 1 << 17  # pixels of a picture that are counted at a time
ROWS = 256  # pictures whose counts are held at a time


def counts_of(data: np.ndarray, channels: int = 1) -> np.ndarray:
    """Counts of a picture's bytes: one row of 256 for gray, four (red, green, blue, luma) for colour."""
    counts = np.zeros((1 if channels == 1 else len(COLOUR), CELLS), np.int64)
    pixels = data[:len(data) // channels * channels].reshape(-1, channels)
    for start in range(0, len(pixels), STRIP):
        strip = pixels[start:start + STRIP, :3]
        planes = list(strip.T) if channels == 1 else [*strip.T, luma(strip[None, :, :]).ravel()]
        counts += np.stack([np.bincount(p, minlength=CELLS) for p in planes])
    return counts


def _cut(column: pa.Array) -> Iterator[pa.Array]:
    """Some rows of an Arrow batch at a time: a batch is as long as the session says, what is made of it isn't."""
    for start in range(0, max(1, len(column)), ROWS):
        yield column.slice(start, ROWS)


def _lists(values: pa.Array, length: int, mask: pa.Array | None = None) -> pa.Array:
    """Lists of ``length`` values each."""
    return pa.ListArray.from_arrays(pa.array(np.arange(0, len(values) + 1, length, dtype=np.int32)), values, mask=mask)


def _histograms(channels: int):
    def count(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        planes = len(GRAY if channels == 1 else COLOUR)
        for batch in batches:
            for some in _cut(batch):
                counts = np.zeros((len(some), planes, CELLS), np.int64)
                for i, picture in enumerate(some):
                    if picture.is_valid:
                        counts[i] = counts_of(np.frombuffer(picture.as_buffer(), np.uint8), channels)
                yield _lists(_lists(pa.array(counts.ravel()), CELLS), planes, pa.array(np.asarray(some.is_null())))

    return count


def histogram(pixels: Column, channels: int = 1) -> Column:
    """One array of 256 counts for each channel of raw pixel bytes (null for null), by an Arrow UDF."""
    return F.arrow_udf(_histograms(channels), "array<array<bigint>>")(pixels)


def merged(counts: DataFrame, keys: list[str], histograms: str = "counts", channels: int = 1) -> DataFrame:
    """The histograms of each group added up: pictures of a key, or strips of one large picture."""
    cells = [F.coalesce(F.sum(F.col(histograms)[c][i]), F.lit(0)).alias(f"c{c}_{i}") for c in range(channels) for i in range(CELLS)]
    added = counts.groupBy(*keys).agg(F.count(F.lit(1)).alias("parts"), *cells)
    arrays = F.array(*[F.array(*[F.col(f"c{c}_{i}") for i in range(CELLS)]) for c in range(channels)])
    return added.select(*keys, "parts", arrays.alias(histograms))


def strips(pictures: DataFrame, pixels: str, size: int, channels: int = 1) -> DataFrame:
    """A picture's bytes in strips of at most ``size`` pixels, a row each: what ``merged`` puts together again."""
    step = size * channels
    starts = F.sequence(F.lit(1), F.greatest(F.length(pixels), F.lit(1)), F.lit(step))
    return pictures.withColumn("_at", F.explode(starts)).withColumn(pixels, F.substring(F.col(pixels), F.col("_at"), F.lit(step))).drop("_at")


def _moments(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    powers = np.arange(CELLS, dtype=np.int64)[:, None] ** np.arange(3)
    for batch in batches:
        for some in _cut(batch):
            sums = some.flatten().flatten().to_numpy().reshape(-1, CELLS) @ powers
            each = pa.StructArray.from_arrays([pa.array(sums[:, k]) for k in range(3)], ["n", "s1", "s2"])
            ends = np.cumsum([0, *(len(r) if r.is_valid else 0 for r in some)], dtype=np.int32)
            yield pa.ListArray.from_arrays(pa.array(ends), each, mask=pa.array(np.asarray(some.is_null())))


def moments(histograms: Column) -> Column:
    """For each channel the whole-number sums over the cells: n, s1 (of values) and s2 (of their squares)."""
    return F.arrow_udf(_moments, "array<struct<n:bigint,s1:bigint,s2:bigint>>")(histograms)


def channel_stats(m: Column) -> Column:
    """mean and population deviation of one channel's moments, null of an empty one."""
    n, s1, s2 = (m[c].cast("decimal(19,0)") for c in ("n", "s1", "s2"))  # products of large pictures' sums leave a long
    return F.when(m["n"] > 0, F.struct((m["s1"] / m["n"]).alias("mean"), (F.sqrt((n * s2 - s1 * s1).cast("double")) / m["n"]).alias("std")))


def with_stats(df: DataFrame, histograms: str = "counts", channels: int = 1) -> DataFrame:
    """mean_rgb, std_rgb, brightness, contrast and quality_score from the counts; gray stands for all three channels."""
    df = df.withColumn("_stats", F.transform(moments(F.col(histograms)), channel_stats))
    rgb = [0, 0, 0] if channels == 1 else [0, 1, 2]
    light = F.col("_stats")[0 if channels == 1 else 3]
    df = (df.withColumn("mean_rgb", F.array(*[F.col("_stats")[c]["mean"] for c in rgb]))
          .withColumn("std_rgb", F.array(*[F.col("_stats")[c]["std"] for c in rgb]))
          .withColumn("brightness", light["mean"] / 255.0).withColumn("contrast", light["std"] / 255.0))
    return df.withColumn("quality_score", quality_score(F.col("contrast"))).drop("_stats")
