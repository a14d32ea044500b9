import numpy as np
import pytest
from pyspark.sql import functions as F

from assetlake.operators import images as IM
from assetlake.plans.medallion import bronze, gold, silver
from assetlake.sources.files import binary_files, decoded_images
from imgutil import png, write


@pytest.fixture()
def image_root(tmp):
    half = np.zeros((40, 50, 3), np.uint8)
    half[:, 25:] = 255
    files = {
        "pizza/pizza_idx_000001.png": png(half, 2),                                  # half black / white
        "pizza/pizza_idx_000002.png": png(np.full((32, 32), 128, np.uint8), 0),      # gray, flat
        "pizza/pizza_idx_000008.png": png(np.zeros((50, 4097, 3), np.uint8), 2),     # too wide
        "sushi/sushi_idx_000003.png": png(np.zeros((31, 40, 3), np.uint8), 2),       # too small
        "sushi/sushi_idx_000004.png": png(np.full((40, 40, 4), 200, np.uint8), 6),   # RGBA
        "sushi/sushi_idx_000005.png": png(np.zeros((40, 40), np.uint8), 3, np.zeros((256, 3))),  # palette
        "sushi/sushi_idx_000009.png": png(np.zeros((40, 40, 2), np.uint8), 4),       # gray + alpha
        "sushi/sushi_idx_000006.png": b"junk",
        "sushi/sushi_idx_000010.png": png(half, 2)[:60],                             # truncated
        "sushi/sushi_idx_000007.PNG": png(half, 2),                                  # upper-case ext
        "sushi/sushi_idx_000011.png": png(np.zeros((4096, 32, 3), np.uint8), 2),     # bound, tall
    }
    for name, data in files.items():
        write(f"{tmp}/{name}", data)
    return tmp


def test_silver_gold_end_to_end(spark, image_root):
    b = bronze(binary_files(spark, image_root), key_from_dir=True)
    tax = spark.createDataFrame([("pizza", "italian"), ("sushi", "japanese")], "key string, group string")
    s, rep = silver(b, decoded_images(spark, image_root), tax)
    rows = {r.image_id: r for r in s.collect()}
    assert set(rows) == {"pizza_000001", "pizza_000002", "sushi_000004", "sushi_000011"}
    r = rows["pizza_000001"]
    assert r.brightness == pytest.approx(0.5) and r.contrast == pytest.approx(0.5) and r.quality_score == 1.0
    assert r.mean_rgb == pytest.approx([127.5] * 3) and r.std_rgb == pytest.approx([127.5] * 3)
    assert (r.original_width, r.original_height, r.aspect_ratio) == (50, 40, 1.25)
    assert rows["pizza_000002"].contrast == 0.0 and rows["pizza_000002"].std_rgb == [0.0, 0.0, 0.0]
    assert rows["sushi_000004"].mean_rgb == pytest.approx([200.0] * 3)
    assert all(x.processed_width == 224 and x.processed_file_size > 0 for x in rows.values())
    rep = {x.rule: x.failed for x in rep.collect()}
    assert rep["good_quality"] == 3 and rep["valid_image_data"] == 0
    g = gold(s, ["pizza", "sushi"], ["italian", "japanese"])
    assert g.columns[:5] == ["image_id", "food_type", "cuisine_category", "food_type_encoded", "cuisine_category_encoded"]
    assert g.filter("food_type_encoded < 0").count() == 0


def test_processed_png_decodes_to_224(spark, image_root, tmp_path):
    b = bronze(binary_files(spark, image_root), key_from_dir=True)
    tax = spark.createDataFrame([("pizza", "italian"), ("sushi", "japanese")], "key string, group string")
    s, _ = silver(b, decoded_images(spark, image_root), tax)
    out = tmp_path / "processed"
    out.mkdir()
    for r in s.select("image_id", "processed_image_data").collect():
        (out / f"{r.image_id}.png").write_bytes(r.processed_image_data)
    dec = spark.read.format("image").load(str(out)).select("image.height", "image.width", "image.nChannels")
    assert {tuple(x) for x in dec.collect()} == {(224, 224, 3)}


def test_letterbox_geometry_sql(spark):
    df = spark.createDataFrame([(50, 40), (40, 50), (32, 32), (4096, 32)], "w int, h int")
    g = IM.letterbox(F.col("w"), F.col("h"))
    got = [tuple(r) for r in df.select(g["new_w"], g["new_h"], g["off_x"], g["off_y"]).collect()]
    assert got == [(224, 179, 0, 22), (179, 224, 22, 0), (224, 224, 0, 0), (224, 1, 0, 111)]


def test_kernels():
    half = np.zeros((40, 50, 3), np.uint8)
    half[:, 25:] = 255
    f = IM.features(half)
    assert f["brightness"] == 0.5 and f["contrast"] == 0.5 and f["quality_score"] == 1.0
    c = IM.letterbox_np(np.full((10, 20, 3), 255, np.uint8), 224)
    assert c.shape == (224, 224, 3) and c[0, 0].tolist() == [0, 0, 0] and c[112, 112].tolist() == [255, 255, 255]
    rgba = np.zeros((2, 2, 4), np.uint8)
    assert IM.to_rgb(rgba, "white").tolist() == [[[255] * 3] * 2] * 2
    assert IM.to_rgb(rgba, "drop").tolist() == [[[0] * 3] * 2] * 2


def test_incremental_stream_three_layers(spark, image_root, tmp_path_factory):
    from assetlake.streaming.incremental import start_incremental

    work = tmp_path_factory.mktemp("incremental")  # outside the source root
    out, ck = str(work / "out"), str(work / "ck")
    tax = spark.createDataFrame([("pizza", "italian"), ("sushi", "japanese")], "key string, group string")
    q = start_incremental(spark, image_root, out, ck, tax, ["pizza", "sushi"], ["italian", "japanese"], max_files=3)
    q.awaitTermination()
    assert spark.read.parquet(f"{out}/bronze").count() == 11
    silver_ids = {r.image_id for r in spark.read.parquet(f"{out}/silver").collect()}
    assert silver_ids == {"pizza_000001", "pizza_000002", "sushi_000004", "sushi_000011"}
    g = spark.read.parquet(f"{out}/gold")
    assert g.count() == 4 and set(g.columns) >= {"dataset_split", "food_type_encoded", "batch_id"}
    rep = spark.read.parquet(f"{out}/dq_report").groupBy("rule").agg(F.sum("failed").alias("f"))
    assert {r.rule: r.f for r in rep.collect()}["good_quality"] == 3
    # a re-run adds nothing; a new file flows through all three layers
    half = np.zeros((40, 50, 3), np.uint8)
    half[:, :25] = 255
    write(f"{image_root}/pizza/pizza_idx_000012.png", png(half, 2))
    q2 = start_incremental(spark, image_root, out, ck, tax, ["pizza", "sushi"], ["italian", "japanese"])
    q2.awaitTermination()
    assert spark.read.parquet(f"{out}/bronze").count() == 12
    assert spark.read.parquet(f"{out}/gold").count() == 5


def _jpeg_via_imageio(spark, path, w, h, split_color=True):
    """JPEG written by the JVM's ImageIO (no Python imaging library)."""
    jvm = spark.sparkContext._jvm
    img = jvm.java.awt.image.BufferedImage(w, h, 1)  # TYPE_INT_RGB
    for y in range(h):
        for x in range(w):
            img.setRGB(x, y, 0xFFFFFF if (split_color and x >= w // 2) else 0x000000)
    f = jvm.java.io.File(path)
    f.getParentFile().mkdirs()
    assert jvm.javax.imageio.ImageIO.write(img, "jpg", f)


def test_jpeg_and_bronze_edge_rows(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("jpeg"))
    _jpeg_via_imageio(spark, f"{root}/ramen/ramen_idx_000001.jpg", 64, 48)
    _jpeg_via_imageio(spark, f"{root}/ramen/noindex.jpeg", 40, 40, split_color=False)
    _jpeg_via_imageio(spark, f"{root}/ramen/ramen_idx_000002.jpg", 40, 40)
    files = binary_files(spark, root)
    # a file row whose content went missing is dropped before any pixel work
    files = files.withColumn("content", F.when(F.col("path").endswith("ramen_idx_000002.jpg"),
                                               F.lit(None).cast("binary")).otherwise(F.col("content")))
    b = bronze(files, key_from_dir=True)
    tax = spark.createDataFrame([("ramen", "japanese")], "key string, group string")
    s, _ = silver(b, decoded_images(spark, root), tax)
    rows = {r.filename: r for r in s.collect()}
    assert set(rows) == {"ramen_idx_000001.jpg", "noindex.jpeg"}
    r = rows["ramen_idx_000001.jpg"]
    assert r.image_id == "ramen_000001" and (r.original_width, r.original_height) == (64, 48)
    assert r.brightness == pytest.approx(0.5, abs=0.02) and r.contrast == pytest.approx(0.5, abs=0.02)
    nid = rows["noindex.jpeg"].image_id  # null index: repeatable hash fallback
    assert nid.startswith("ramen_") and len(nid) == 14 and rows["noindex.jpeg"].dataset_index is None
    assert s.schema["processed_image_data"].metadata["spark.contentAnnotation"] == '{"mimeType": "image/png"}'


def test_document_pictures_brute_force(spark):
    """image_gold on sf0.001 against numpy statistics of the raw text bytes."""
    from assetlake.plans.q_images import image_gold
    from conftest import SF001

    got = {r.dataset_index: r for r in image_gold(spark, SF001).collect()}
    docs = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text").collect()
    for d in docs:
        data = np.frombuffer((d.text or "").encode(), np.uint8)
        w = max(32, min(4096, int(len(data) ** 0.5)))
        h = max(32, -(-len(data) // w))
        flat = np.zeros(w * h)
        flat[:len(data)] = data
        r = got.pop(d.doc_id)
        assert r.mean == pytest.approx(flat.mean(), abs=2e-6) and r.std == pytest.approx(flat.std(), abs=2e-6)
        assert r.aspect_ratio == pytest.approx(w / h, abs=2e-6)
    assert not got


def test_silver_counts_rows_whose_file_is_gone(spark, tmp_path):
    for i in range(3):
        write(f"{tmp_path}/pizza/pizza_idx_{i:06d}.png", png(np.full((40, 40, 3), 90 * i, np.uint8), 2))
    b = bronze(binary_files(spark, str(tmp_path)), key_from_dir=True)
    b.write.parquet(str(tmp_path / "table"))
    (tmp_path / "pizza" / "pizza_idx_000001.png").unlink()
    tax = spark.createDataFrame([("pizza", "italian")], "key string, group string")
    kept, rep = silver(spark.read.parquet(str(tmp_path / "table")), decoded_images(spark, str(tmp_path / "pizza")), tax)
    assert {r.image_id for r in kept.collect()} == {"pizza_000000", "pizza_000002"}
    assert {r.rule: (r.checked, r.failed) for r in rep.collect()}["valid_image_data"] == (3, 1)


def test_resize_matches_dense_reference():
    rng = np.random.default_rng(1)
    img = rng.integers(0, 256, (57, 91, 3), dtype=np.uint8)
    out = IM.resize(img, 40, 25)
    # dense float64 evaluation of the same separable kernel
    wy = np.zeros((25, 57))
    for o in range(25):
        idx, w = IM._band(57, 25)
        for j, v in zip(idx[o], w[o]):
            wy[o, j] += v
    wx = np.zeros((40, 91))
    for o in range(40):
        idx, w = IM._band(91, 40)
        for j, v in zip(idx[o], w[o]):
            wx[o, j] += v
    ref = np.einsum("oh,hwc->owc", wy, img.astype(np.float64))
    ref = np.einsum("pw,owc->opc", wx, ref)
    assert np.abs(out.astype(int) - np.clip(np.rint(ref), 0, 255).astype(int)).max() <= 1
    flat = np.full((33, 47, 3), 77, np.uint8)
    assert (IM.resize(flat, 224, 157) == 77).all()  # weights sum to 1: flat stays flat


def test_png_roundtrip_through_image_source(spark, tmp_path):
    rng = np.random.default_rng(3)
    rgb = rng.integers(0, 256, (37, 53, 3), dtype=np.uint8)
    gray = rng.integers(0, 256, (41, 35), dtype=np.uint8)
    (tmp_path / "rgb.png").write_bytes(IM.png_bytes(rgb))
    (tmp_path / "gray.png").write_bytes(IM.png_bytes(gray))
    rows = {r.origin.rsplit("/", 1)[-1]: r for r in
            spark.read.format("image").load(str(tmp_path)).select("image.*").collect()}
    r = rows["rgb.png"]
    got = np.frombuffer(bytes(r.data), np.uint8).reshape(r.height, r.width, r.nChannels)[:, :, ::-1]  # BGR -> RGB
    assert (got == rgb).all()
    g = rows["gray.png"]
    assert (np.frombuffer(bytes(g.data), np.uint8).reshape(g.height, g.width) == gray).all()


def test_normalise_chw(spark):
    canvas = np.zeros((224, 224, 3), np.uint8)
    canvas[:, :, 0] = 255
    df = spark.createDataFrame([(bytearray(canvas.tobytes()),), (None,)], "b binary")
    out = IM.normalise(df, "b").collect()
    v = np.asarray(out[0].pixel_values, dtype=np.float32).reshape(3, 224, 224)
    assert v[0, 0, 0] == pytest.approx((1.0 - 0.485) / 0.229, rel=1e-5)
    assert v[1, 5, 5] == pytest.approx((0.0 - 0.456) / 0.224, rel=1e-5)
    assert out[1].pixel_values is None


def test_ignore_case_option(spark, image_root):
    b = bronze(binary_files(spark, image_root), key_from_dir=True)
    tax = spark.createDataFrame([("pizza", "italian"), ("sushi", "japanese")], "key string, group string")
    strict, _ = silver(b, decoded_images(spark, image_root), tax)
    loose, _ = silver(b, decoded_images(spark, image_root), tax, ignore_case=True)
    extra = {r.filename for r in loose.collect()} - {r.filename for r in strict.collect()}
    assert extra == {"sushi_idx_000007.PNG"}


def test_rerun_micro_batch_is_idempotent(spark, image_root, tmp_path_factory):
    from assetlake.streaming.incremental import process_batch

    out = str(tmp_path_factory.mktemp("rerun") / "out")
    tax = spark.createDataFrame([("pizza", "italian"), ("sushi", "japanese")], "key string, group string")
    batch = bronze(binary_files(spark, image_root), key_from_dir=True)
    for _ in range(2):  # the same batch id twice, as after a failure and restart
        process_batch(spark, batch, 7, out, tax, ["pizza", "sushi"], ["italian", "japanese"])
    assert spark.read.parquet(f"{out}/bronze").count() == 11
    assert spark.read.parquet(f"{out}/gold").count() == 4
    assert spark.read.parquet(f"{out}/dq_report").count() == 5


def test_png_color_type_reads_the_bit_depth(spark):
    head = bytes.fromhex("89504E470D0A1A0A") + bytes(8) + bytes(8)
    cases = [(8, 0, 0), (1, 0, IM.ODD_GRAY), (16, 0, IM.ODD_GRAY), (4, 0, 0), (8, 2, 2), (16, 2, 2), (8, 3, 3), (16, 4, 4)]
    df = spark.createDataFrame([(bytearray(head + bytes([d, t])),) for d, t, _ in cases] + [(bytearray(b"GIF89a"),)], "content binary")
    assert [r[0] for r in df.select(IM.png_color_type(F.col("content"))).collect()] == [w for *_, w in cases] + [None]
