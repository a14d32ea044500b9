from pyspark.sql import functions as F

from assetlake.functions import columns as C


def _one(spark, expr, **vals):
    cols = ", ".join(f"'{v}' AS {k}" if v is not None else f"CAST(NULL AS STRING) AS {k}" for k, v in vals.items())
    return spark.sql(f"SELECT {cols}").select(expr.alias("r")).first()["r"]


def test_basename_extension(spark):
    cases = {
        "/v/pizza/pizza_idx_000001.jpg": ("pizza_idx_000001.jpg", "jpg"),
        "/v/pizza/": ("", ""),
        "/v/a.b/c.tar.gz": ("c.tar.gz", "gz"),
        "/v/x/noext": ("noext", ""),
        "/v/x/UP.JPG": ("UP.JPG", "JPG"),
    }
    for p, (fn, ext) in cases.items():
        assert _one(spark, C.basename("p"), p=p) == fn
        assert _one(spark, C.extension(C.basename("p")), p=p) == ext


def test_dataset_index_lenient_and_strict(spark):
    cases = {
        "pizza_idx_000000.jpg": (0, 0),
        "pizza_idx_999999.jpg": (999999, 999999),
        "pizza_idx_1234567.jpg": (1234567, 1234567),
        "x_idx_.jpg": (None, None),
        "a_idx_12x.jpg": (12, None),
        "noindex.jpg": (None, None),
        "a_idx_1_idx_2.jpg": (1, 1),
        "a_idx_-5.jpg": (None, -5),
        "a_idx_99999999999999999999.jpg": (None, None),
    }
    for fn, (lenient, strict) in cases.items():
        assert _one(spark, C.dataset_index("f"), f=fn) == lenient, fn
        assert _one(spark, C.dataset_index("f", strict=True), f=fn) == strict, fn


def test_asset_id_and_filename(spark):
    df = spark.createDataFrame([("pizza", 7, "/p/a.jpg"), ("pizza", 1234567, "/p/b.jpg"), ("sushi", None, "/p/c.jpg")],
                               "k string, i bigint, p string")
    r = df.select(C.asset_id("k", "i", "p").alias("id"), C.asset_filename("k", "i").alias("fn")).collect()
    assert r[0]["id"] == "pizza_000007" and r[0]["fn"] == "pizza_idx_000007.jpg"
    assert r[1]["id"] == "pizza_1234567"  # never truncated
    assert r[2]["id"].startswith("sushi_") and len(r[2]["id"]) == len("sushi_") + 8
    again = df.select(C.asset_id("k", "i", "p").alias("id")).collect()[2]["id"]
    assert again == r[2]["id"]  # repeatable fallback


def test_parent_title_mask_b64(spark):
    assert _one(spark, C.parent_dir("p"), p="/a/b/c.json") == "/a/b"
    assert _one(spark, C.parent_dir("p"), p="c.json") == ""
    assert _one(spark, C.title("t"), t="spaghetti_bolognese") == "Spaghetti_Bolognese"
    assert _one(spark, C.title("t"), t="hot dog") == "Hot Dog"
    for text, want in (("they.re", "They.Re"), ("a-b", "A-B"), ("pho2go", "Pho2Go"), ("x/y  z", "X/Y  Z"), ("ÉCLAIR au chocolat", "Éclair Au Chocolat")):
        assert _one(spark, C.title("t"), t=text) == want
    assert _one(spark, C.mask("t"), t="dapi1234567890abcdef") == "dapi123456***"
    long = "x" * 500
    b = spark.sql(f"SELECT encode('{long}', 'UTF-8') AS b").select(C.b64("b").alias("s")).first()["s"]
    assert "\n" not in b and "\r" not in b and len(b) == 668
    assert spark.range(1).select(C.byte_size(F.lit(None).cast("binary")).alias("n")).first()["n"] == 0


def _py_lenient(fn):
    import re
    if "_idx_" not in fn:
        return None
    m = re.search(r"_idx_(\d+)", fn)
    if not m:
        return None
    v = int(m.group(1))
    return v if v < 2 ** 63 else None


def _py_strict(fn):
    import re
    if "_idx_" not in fn:
        return None
    part = fn.split("_idx_")[1].split(".")[0]
    if not re.fullmatch(r"\s*[+-]?[0-9]+(_[0-9]+)*\s*", part):
        return None
    v = int(part)
    return v if -(2 ** 63) <= v < 2 ** 63 else None


def test_index_parsers_match_python_reference(spark):
    from hypothesis import given, settings
    from hypothesis import strategies as st

    pieces = st.sampled_from(["_idx_", "pizza", "0", "7", "12", "000123", ".jpg", ".", "x", "-", "+", "_", "a.b"])
    names = st.lists(st.lists(pieces, min_size=1, max_size=6).map("".join), min_size=20, max_size=40)

    @settings(max_examples=15, deadline=None)
    @given(names)
    def check(batch):
        df = spark.createDataFrame([(n,) for n in batch], "f string")
        got = df.select("f", C.dataset_index("f").alias("l"), C.dataset_index("f", strict=True).alias("s")).collect()
        for r in got:
            assert r.l == _py_lenient(r.f), r.f
            assert r.s == _py_strict(r.f), r.f

    check()
