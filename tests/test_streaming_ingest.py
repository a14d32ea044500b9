import os

from pyspark.sql import functions as F

from assetlake.operators import ingest as I
from assetlake.sinks.files import ingest, write_assets
from assetlake.streaming.bronze import start_bronze
from imgutil import write


def test_bronze_stream_once_per_file(spark, tmp):
    src, out, ck = f"{tmp}/src", f"{tmp}/bronze", f"{tmp}/ck"
    for i in range(5):
        write(f"{src}/pizza/pizza_idx_{i:06d}.jpg", b"x" * (i + 1))
    write(f"{src}/sushi/sushi_idx_000100.jpg", b"y")
    q = start_bronze(spark, src, out, ck, max_files=2)
    q.awaitTermination()
    assert q.recentProgress and max(p["numInputRows"] for p in q.recentProgress) <= 2  # rate limit
    df = spark.read.parquet(out)
    assert df.count() == 6
    r = df.filter("food_type = 'sushi'").first()
    assert (r.filename, r.file_format, r.dataset_index, r.length) == ("sushi_idx_000100.jpg", "jpg", 100, 1)
    # second run: nothing new; an overwrite is not re-read
    write(f"{src}/pizza/pizza_idx_000000.jpg", b"changed")
    q2 = start_bronze(spark, src, out, ck, max_files=2)
    q2.awaitTermination()
    assert spark.read.parquet(out).count() == 6
    write(f"{src}/pizza/pizza_idx_000009.jpg", b"new")
    q3 = start_bronze(spark, src, out, ck)
    q3.awaitTermination()
    assert spark.read.parquet(out).count() == 7


def _examples(spark):
    rows = []
    for i in range(40):
        key = ["pizza", "sushi", "ramen", "taco"][i % 4]
        rows.append((i, key, bytes([i])))
    return spark.createDataFrame(rows, "idx bigint, key string, content binary")


def test_plan_high_water_and_first_n(spark):
    ex = _examples(spark)
    status = I.status_frame(spark, [("pizza", 3, 8, "pizza_idx_000008.jpg"), ("sushi", 9, None, None)])
    wanted = spark.createDataFrame([("pizza",), ("sushi",), ("nope",)], "key string")
    p = I.plan(ex, status, wanted, 3)
    got = sorted((r.key, r.idx) for r in p.collect())
    assert got == [("pizza", 12), ("pizza", 16), ("pizza", 20), ("sushi", 1), ("sushi", 5), ("sushi", 9)]
    merged = {r.key: (r["count"], r.last_index, r.last_filename) for r in I.merge_status(status, p).collect()}
    assert merged["pizza"] == (6, 20, "pizza_idx_000020.jpg")
    assert merged["sushi"] == (3, 9, "sushi_idx_000009.jpg")  # legacy row restarts at 0


def test_two_runs_of_n_equal_one_run_of_2n(spark):
    ex = _examples(spark)
    empty = I.status_frame(spark, [])
    wanted = spark.createDataFrame([("pizza",), ("ramen",)], "key string")
    one = I.merge_status(empty, I.plan(ex, empty, wanted, 4))
    s1 = I.merge_status(empty, I.plan(ex, empty, wanted, 2))
    s2 = I.merge_status(s1, I.plan(ex, s1, wanted, 2))
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, s2.collect()))


def test_write_assets_and_ingest_with_failure(spark, tmp):
    root = f"{tmp}/vol"
    ex = _examples(spark).withColumn("content", F.when(F.col("idx") == 4, F.lit(None).cast("binary"))
                                     .otherwise(F.col("content")))
    status = I.status_frame(spark, [])
    wanted = spark.createDataFrame([("pizza",), ("sushi",)], "key string")
    new_status, results = ingest(ex, status, wanted, 3, root)
    errs = results.filter("error IS NOT NULL").collect()
    assert [(e.key, e.idx) for e in errs] == [("pizza", 4)]
    st = {r.key: (r["count"], r.last_index) for r in new_status.collect()}
    assert st == {"pizza": (3, 12), "sushi": (3, 9)}  # the failed slot was refilled by idx 12
    assert sorted(os.listdir(f"{root}/pizza")) == ["pizza_idx_000000.jpg", "pizza_idx_000008.jpg", "pizza_idx_000012.jpg"]
    with open(f"{root}/sushi/sushi_idx_000005.jpg", "rb") as f:
        assert f.read() == bytes([5])


def test_report_listing(spark):
    picked = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "key string, idx bigint")
    wanted = spark.createDataFrame([(k,) for k in ["a", "b", "c"]], "key string")
    r = {x.key: x for x in I.run_report(picked, wanted, 2).collect()}
    assert r["a"].complete and not r["b"].complete and r["c"].new == 0
    assert r["a"].total_saved == 3 and r["a"].completed_keys == 1 and not r["a"].all_complete
    assert r["a"].hidden_keys == 0


def test_refill_goes_on_past_many_bad_rows(spark, tmp):
    """Twice n unreadable rows first: the run still saves n files."""
    ex = spark.createDataFrame([("k", i, None if i < 9 else bytearray(b"x")) for i in range(14)], "key string, idx long, content binary")
    status = spark.createDataFrame([], "key string, count long, last_index long, last_filename string")
    wanted = spark.createDataFrame([("k",)], "key string")
    new_status, results = ingest(ex, status, wanted, 2, os.path.join(tmp, "files"))
    assert results.where("error IS NULL").count() == 2
    assert new_status.first()["last_index"] == 10
