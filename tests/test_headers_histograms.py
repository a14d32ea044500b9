"""Header walk and byte histograms against brute force."""

import struct
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from assetlake.operators import histograms as HI
from assetlake.operators import images as IM
from assetlake.operators.headers import header, passes
from imgutil import png


def _jpeg(width, height, parts, before=(), marker=0xC0, bits=8, end=b"\xff\xda\0\0"):
    """A JPEG up to its scan: segments (marker, payload) in front of the frame header."""
    out = b"\xff\xd8"
    for m, payload in before:
        out += bytes([0xFF, m]) + (struct.pack(">H", len(payload) + 2) + payload if payload is not None else b"")
    return out + bytes([0xFF, marker]) + struct.pack(">HBHHB", 8 + 3 * parts, bits, height, width, parts) + bytes(3 * parts) + end


CASES = [
    (png(np.zeros((40, 50, 3), np.uint8), 2), ("png", 50, 40, "RGB")),
    (png(np.zeros((40, 50), np.uint8), 0), ("png", 50, 40, "L")),
    (png(np.zeros((31, 50, 4), np.uint8), 6), ("png", 50, 31, "RGBA")),
    (png(np.zeros((40, 50, 2), np.uint8), 4), ("png", 50, 40, "LA")),
    (png(np.zeros((40, 50), np.uint8), 3, np.zeros((4, 3))), ("png", 50, 40, "P")),
    (png(np.zeros((40, 50), np.uint8), 0)[:24] + b"\x10" + png(np.zeros((40, 50), np.uint8), 0)[25:], ("png", 50, 40, "other")),
    (png(np.zeros((40, 50), np.uint8), 0)[:20], None),
    (_jpeg(640, 480, 3), ("jpeg", 640, 480, "RGB")),
    (_jpeg(640, 480, 1, marker=0xC2), ("jpeg", 640, 480, "L")),
    (_jpeg(640, 480, 4, marker=0xCF), ("jpeg", 640, 480, "CMYK")),
    (_jpeg(640, 480, 3, bits=12), ("jpeg", 640, 480, "other")),
    # a thumbnail's frame header inside a segment is not the picture's; tables and fill bytes are passed
    (_jpeg(5000, 33, 3, [(0xE1, b"Exif" + _jpeg(9, 9, 1)), (0xC4, b"\0" * 40), (0xD0, None), (0xFF, None), (0xFE, b"")]), ("jpeg", 5000, 33, "RGB")),
    (_jpeg(70, 80, 3, [(0xFE, b"x" * (i % 50)) for i in range(300)]), ("jpeg", 70, 80, "RGB")),
    (_jpeg(70, 80, 3, [(0xEE, b"\xff" * 65533)] * 3), ("jpeg", 70, 80, "RGB")),
    (b"\xff\xd8\xff\xda\0\x04\0\0" + _jpeg(70, 80, 3), None),   # a scan before any frame header
    (_jpeg(70, 80, 3)[:9], None),
    (b"\xff\xd8\xff\xfe\0\x01", None),                            # a segment shorter than its length
    (b"\xff\xd8\0" + _jpeg(70, 80, 3), None),
    (b"\xff\xd8", None), (b"GIF89a" + bytes(60), None), (b"", None), (None, None),
]


def test_header_walk(spark):
    d = spark.createDataFrame([(i, None if c is None else bytearray(c)) for i, (c, _) in enumerate(CASES)], "i int, content binary")
    rows = {r.i: r for r in d.select("i", header(F.col("content")).alias("h"), passes(header(F.col("content"))).alias("ok")).collect()}
    for i, (_, want) in enumerate(CASES):
        assert (tuple(rows[i].h) if rows[i].h else None) == want, i
        fine = want is not None and want[3] in ("RGB", "RGBA", "L") and all(32 <= s <= 4096 for s in want[1:3])
        assert rows[i].ok == fine, i
    assert d.limit(0).select(header(F.col("content"))).count() == 0


def test_header_agrees_with_the_decoder(spark, tmp_path):
    from test_images import _jpeg_via_imageio
    _jpeg_via_imageio(spark, f"{tmp_path}/a.jpg", 64, 48)
    (tmp_path / "b.png").write_bytes(png(np.zeros((33, 47, 4), np.uint8), 6))
    files = spark.read.format("binaryFile").load(str(tmp_path)).select(F.col("_metadata.file_path").alias("f"), header(F.col("content")).alias("h"))
    images = spark.read.format("image").load(str(tmp_path)).select(F.col("_metadata.file_path").alias("f"), "image.width", "image.height")
    rows = files.join(images, "f").collect()
    assert len(rows) == 2 and all((r.h.width, r.h.height) == (r.width, r.height) for r in rows)


@pytest.mark.parametrize("channels", [1, 3, 4])
def test_histogram_statistics_equal_the_pixels(spark, channels):
    rng = np.random.default_rng(channels)
    pictures = [rng.integers(0, 256, (h, w, channels), dtype=np.uint8) for h, w in ((40, 33), (1, 1), (64, 90))]
    pictures.append(np.full((50, 50, channels), 7, np.uint8))
    d = spark.createDataFrame([(i, bytearray(p.tobytes())) for i, p in enumerate(pictures)] + [(9, None), (10, bytearray())], "i int, pixels binary")
    whole = d.withColumn("counts", HI.histogram(F.col("pixels"), channels))
    rows = {r.i: r for r in HI.with_stats(whole, channels=channels).collect()}
    for i, p in enumerate(pictures):
        f = IM.features(p if channels == 1 else IM.to_rgb(p))
        for name in ("mean_rgb", "std_rgb", "brightness", "contrast", "quality_score"):
            assert rows[i][name] == pytest.approx(f[name], rel=1e-12, abs=1e-12), (i, name)
    assert rows[9].mean_rgb == [None] * 3 and rows[10].brightness is None


def test_strips_of_a_picture_merge_to_the_whole(spark):
    rng = np.random.default_rng(5)
    rows = [(f"p{i}", bytearray(rng.integers(0, 256, n * 3, dtype=np.uint8).tobytes())) for i, n in enumerate((1, 99, 100, 101, 1234))]
    d = spark.createDataFrame(rows + [("empty", bytearray())], "name string, pixels binary")
    cut = HI.strips(d, "pixels", 100, 3)
    assert cut.where("name = 'p4'").count() == 13
    parts = HI.merged(cut.withColumn("counts", HI.histogram(F.col("pixels"), 3)), ["name"], channels=4)
    whole = {r.name: r.counts for r in d.withColumn("counts", HI.histogram(F.col("pixels"), 3)).collect()}
    assert {r.name: r.counts for r in parts.collect()} == whole


def test_histograms_of_long_batches_take_little_memory():
    """A batch of a large table is as long as the session says; its counts are held some rows at a time."""
    pictures = pa.array([bytes([i % 256]) * 1100 for i in range(5000)] + [None])
    tracemalloc.start()
    parts, values, peak = 0, 0, 0
    for counts in HI._histograms(1)(iter([pictures])):
        assert counts.is_null().to_pylist() == [i == 5000 for i in range(values, values + len(counts))]
        assert all(r is None or r[0][i % 256] == 1100 for i, r in enumerate(counts.to_pylist(), values))
        m = next(HI._moments(iter([counts]))).to_pylist()
        assert all(r is None or r == [{"n": 1100, "s1": 1100 * (i % 256), "s2": 1100 * (i % 256) ** 2}] for i, r in enumerate(m, values))
        parts, values = parts + 1, values + len(counts)
        peak = max(peak, counts.nbytes)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert values == 5001 and parts > 10
    assert peak < 1 << 20 and most < 8 << 20, (peak, most)


def test_counts_of_a_large_picture_take_little_memory():
    data = np.arange(1 << 24, dtype=np.uint32).astype(np.uint8)
    tracemalloc.start()
    counts = HI.counts_of(data)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert (counts == 1 << 16).all() and counts.shape == (1, 256)
    assert most < 8 << 20, most
