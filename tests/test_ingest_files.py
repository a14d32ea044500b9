"""Ingest from files: what is planned on, what is read, what is tried again."""

import os

import pytest
from pyspark.sql import functions as F

from assetlake.operators import ingest as I
from assetlake.sinks import blob
from assetlake.sinks.files import ingest
from assetlake.sinks.tables import append_status, current_status


def _table(spark, path, rows, files=4):
    """Examples as Parquet files, each with a span of indexes."""
    df = spark.createDataFrame(rows, "key string, idx long, content binary")
    df.repartitionByRange(files, "idx").write.parquet(path)
    return spark.read.parquet(path)


def _scans(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [line for line in plan.splitlines() if "FileScan parquet" in line], plan


def test_planning_reads_no_bytes_and_joins_nothing(spark, tmp):
    ex = _table(spark, f"{tmp}/ex", [("ab"[i % 2], i, bytearray(b"x" * 100)) for i in range(40)])
    status = I.status_frame(spark, [("a", 1, 5, "f")])
    wanted = spark.createDataFrame([("a",), ("b",), (None,), ("a",)], "key string")
    picked = I.plan(I.located(ex), status, wanted, 3)
    scans, plan = _scans(picked)
    assert scans and all("content" not in line for line in scans)
    before_window = plan[plan.index("WindowGroupLimit"):]
    assert plan.count("WindowGroupLimit") >= 2
    assert "Join" not in before_window.split("Subquery")[0]
    got = sorted((r.key, r.idx) for r in picked.collect())
    assert got == [("a", 6), ("a", 8), ("a", 10), ("b", 1), ("b", 3), ("b", 5)]


def test_fetch_opens_only_the_files_of_picked_rows(spark, tmp):
    ex = _table(spark, f"{tmp}/ex", [("a", i, bytearray([i])) for i in range(40)] + [("a", 3, bytearray(b"twin"))])
    picked = I.located(ex).where("idx = 3").checkpoint()
    full = I.fetch(ex, picked)
    assert sorted(bytes(r.content) for r in full.collect()) == [b"\x03", b"twin"]  # equal keys are told apart by place
    files = full.select("source_file").distinct().count()
    scan = full._jdf.queryExecution().executedPlan().toString()
    assert files == 1 and "content" in scan
    assert I.fetch(ex, picked.limit(0)).count() == 0


@pytest.mark.parametrize("stored", [True, False])
def test_a_thousand_bad_rows_are_passed_quickly_and_once(spark, tmp, monkeypatch, stored):
    rows = [("bad", i, None) for i in range(1000)] + [("bad", 1000 + i, bytearray(b"ok")) for i in range(9)]
    rows += [("fine", 2000 + i, bytearray(b"ok")) for i in range(9)] + [("none", 3000, None)]
    ex = _table(spark, f"{tmp}/ex", rows) if stored else spark.createDataFrame(rows, "key string, idx long, content binary")
    wanted = spark.createDataFrame([("bad",), ("fine",), ("none",)], "key string")
    from assetlake.sinks import files as sink
    passes, run = [], sink._pinned

    def counted(*a):
        out = run(*a)
        passes.append(out.count())
        return out

    monkeypatch.setattr(sink, "_pinned", counted)
    status, results = ingest(ex, I.status_frame(spark, []), wanted, 2, f"{tmp}/vol")
    assert len(passes) <= 12 and results.where("error IS NULL").count() == 4
    assert sorted(os.listdir(f"{tmp}/vol/bad")) == ["bad_idx_001000.jpg", "bad_idx_001001.jpg"]
    state = {r.key: (r["count"], r.last_index, r[I.TRIED]) for r in status.collect()}
    assert state == {"bad": (2, 1001, 1001), "fine": (2, 2001, 2001), "none": (0, None, 3000)}
    # the next run goes on behind them: one pass with the next files, one key has none
    passes.clear()
    status, results = ingest(ex, status, wanted, 2, f"{tmp}/vol")
    assert results.where("error IS NOT NULL").count() == 0 and len(passes) == 1
    state = {r.key: (r["count"], r.last_index, r[I.TRIED]) for r in status.collect()}
    assert state == {"bad": (4, 1003, 1003), "fine": (4, 2003, 2003), "none": (0, None, 3000)}


def test_a_pass_stops_at_the_last_missing_file(spark, tmp):
    """Later passes look at more candidates than are missing, but write no more than that."""
    rows = [("k", i, None if i in (0, 1, 3) else bytearray(b"x")) for i in range(50)]
    _, results = ingest(spark.createDataFrame(rows, "key string, idx long, content binary"), I.status_frame(spark, []),
                        spark.createDataFrame([("k",)], "key string"), 3, f"{tmp}/vol")
    assert sorted(os.listdir(f"{tmp}/vol/k")) == [f"k_idx_{i:06d}.jpg" for i in (2, 4, 5)]
    assert results.where("error IS NULL").count() == 3 and results.agg(F.max("idx")).first()[0] == 5


def test_status_is_appended_and_a_cut_write_leaves_the_old_one(spark):
    schema = I.STATUS_SCHEMA
    first = spark.createDataFrame([("a", 1, 5, "x"), ("b", 2, 6, "y")], schema)
    assert append_status(first, "status_log") == 1
    assert append_status(spark.createDataFrame([("a", 3, 9, "z")], schema), "status_log") == 2
    want = {("a", 3, 9, "z"), ("b", 2, 6, "y")}
    assert {tuple(r) for r in current_status(spark, "status_log").select(*schema.names).collect()} == want
    # rows of a run that never got its mark
    (spark.createDataFrame([("a", 7, 70, "cut")], schema).withColumn("run", F.lit(3).cast("long")).withColumn("complete", F.lit(False))
     .write.mode("append").format("parquet").saveAsTable("status_log"))
    assert {tuple(r) for r in current_status(spark, "status_log").select(*schema.names).collect()} == want
    assert append_status(spark.createDataFrame([("c", 1, 1, "n")], schema), "status_log") == 4


def test_listing_has_every_key(spark):
    rows = [(f"k{i:02}", i, None if i == 3 else i * 10, f"f{i}") for i in range(25)] + [(None, 1, 1, "x")]
    got = sorted(I.status_listing(spark.createDataFrame(rows, I.STATUS_SCHEMA)).collect(), key=lambda r: r.listing_rank)
    assert [r.key for r in got] == [f"k{i:02}" for i in range(25)] and [r.listing_rank for r in got] == list(range(1, 26))
    assert {r.hidden_keys for r in got} == {5} and sum(r.shown for r in got) == 20
    assert got[3].line == "f3 (old format)" and got[3].legacy and got[4].line == "4 images | last_index: 40"
    assert I.status_listing(I.status_frame(spark, [])).count() == 0


def test_paths_without_scheme_belong_to_the_default_file_system():
    class Conf(dict):
        get = dict.get

    class Session:
        def __init__(self, master, default, checkpoint=""):
            self.conf = Conf({"spark.checkpoint.dir": checkpoint})
            self.sparkContext = type("C", (), {"master": master, "_jsc": type("J", (), {"hadoopConfiguration": lambda _: Conf({"fs.defaultFS": default})})()})()

    assert blob.shared_root(Session("local[4]", "file:///"), "/data/x") == "/data/x"
    assert blob.shared_root(Session("yarn", "hdfs://nn:8020/"), "/data/x") == "hdfs://nn:8020/data/x"
    assert blob.shared_root(Session("yarn", "file:///"), "s3://b/x") == "s3://b/x"
    assert blob.shared_root(Session("spark://m:1", "file:///", "file:/shared"), "/shared/vol") == "/shared/vol"
    with pytest.raises(ValueError):
        blob.shared_root(Session("spark://m:1", "file:///"), "/data/x")
