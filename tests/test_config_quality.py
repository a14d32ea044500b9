import json
import os

import pytest
from pyspark.sql import functions as F

from assetlake.operators.changes import snapshot_changes
from assetlake.operators.quality import Rules, apply_rules
from assetlake.sources import config as CF


def _write(tmp, name, text):
    p = os.path.join(tmp, name)
    with open(p, "w") as f:
        f.write(text)
    return p


def test_taxonomy_inverse_last_wins(spark, tmp):
    p = _write(tmp, "taxonomy.json", json.dumps({"italian": ["pizza", "pasta"], "empty": [],
                                                 "american": ["burger", "pizza"]}))
    tax = CF.taxonomy(spark, p)
    inv = {r.key: (r.group, r.n_groups) for r in CF.invert(tax).collect()}
    assert inv == {"pizza": ("american", 2), "pasta": ("italian", 1), "burger": ("american", 1)}
    c = CF.counts(tax).first()
    assert (c.groups, c.listed_keys, c.keys) == (3, 4, 3)


@pytest.mark.parametrize("text", ["{not json", "{}", "[]"])
def test_taxonomy_bad(spark, tmp, text):
    p = _write(tmp, "bad.json", text)
    with pytest.raises(CF.ConfigError):
        CF.taxonomy(spark, p)


def test_taxonomy_missing(spark, tmp):
    with pytest.raises(CF.ConfigError):
        CF.taxonomy(spark, os.path.join(tmp, "nope.json"))


def test_key_list(spark, tmp):
    p = _write(tmp, "keys.json", json.dumps(["pizza", "pasta", "burger"]))
    assert [r.key for r in CF.key_list(spark, p).orderBy("pos").collect()] == ["pizza", "pasta", "burger"]


def test_rules_drop_warn_and_report(spark):
    df = spark.createDataFrame([(1, 0.5), (2, 0.29), (None, 0.3), (4, None)], "k int, q double")
    rules = Rules(drop={"has_k": "k IS NOT NULL"}, warn={"good": "q >= 0.3"})
    kept, rep = apply_rules(df, rules)
    assert kept.count() == 3
    r = {x.rule: (x.action, x.checked, x.failed) for x in rep.collect()}
    assert r["has_k"] == ("drop", 4, 1)
    assert r["good"] == ("warn", 4, 2)  # 0.29 fails, NULL fails, 0.3 passes
    dropped = df.subtract(kept).count()
    assert dropped + kept.count() == df.count()


def test_snapshot_changes(spark):
    old = spark.createDataFrame([(1, "a", None), (2, "b", 1), (3, None, None), (4, "d", 4)], "id int, x string, y int")
    new = spark.createDataFrame([(1, "a", None), (2, "b", 2), (3, None, None), (5, "e", 5)], "id int, x string, y int")
    got = {r.id: r.change_type for r in snapshot_changes(old, new, "id", keep_same=True).collect()}
    assert got == {1: "same", 2: "update", 3: "same", 4: "delete", 5: "insert"}


def test_check_taxonomy_against_keys(spark, tmp):
    tp = _write(tmp, "tax.json", json.dumps({"italian": ["pizza", "pasta"], "american": ["burger"]}))
    kp = _write(tmp, "keys.json", json.dumps(["pizza", "burger", "sushi"]))
    got = {r.key: (r.in_taxonomy, r.in_key_list) for r in CF.check(CF.taxonomy(spark, tp), CF.key_list(spark, kp)).collect()}
    assert got == {"pizza": (True, True), "burger": (True, True), "pasta": (True, False), "sushi": (False, True)}


def test_labelled_examples_names_and_wanted(spark):
    from assetlake.operators.encode import names_lookup
    from assetlake.operators.ingest import plan, status_frame
    names = ["apple_pie", "pizza", "sushi", "tacos"]
    # interleaved labels, an unwanted label (tacos) and one outside the names array (7)
    ex = spark.createDataFrame([(i, [1, 2, 3, 7, 1, 2][i % 6], bytes([i])) for i in range(24)],
                               "idx bigint, label int, content binary")
    ex = names_lookup(ex, "label", names, "key")
    wanted = spark.createDataFrame([("pizza",), ("sushi",), ("ramen",)], "key string")
    p = plan(ex, status_frame(spark, []), wanted, 3)
    got = sorted((r.key, r.idx) for r in p.collect())
    assert got == [("pizza", 0), ("pizza", 4), ("pizza", 6), ("sushi", 1), ("sushi", 5), ("sushi", 7)]


def test_params_from_conf(spark):
    spark.conf.set("assetlake.config_volume_path", "/cfg")
    spark.conf.set("assetlake.bronze_volume_path", "/bronze")
    spark.conf.set("assetlake.random_seed", "7")
    p = CF.Params.from_conf(spark)
    assert (p.config_path, p.bronze_path, p.random_seed, p.silver_schema, p.max_files_per_trigger) == (
        "/cfg", "/bronze", 7, "silver", 100)
    spark.conf.unset("assetlake.config_volume_path")
    with pytest.raises(CF.ConfigError):
        CF.Params.from_conf(spark)


def test_snapshot_diff_on_bucketed_tables_has_no_shuffle(spark, tmp):
    from assetlake.sinks.tables import write_bucketed
    old = spark.range(0, 2000).select(F.col("id"), (F.col("id") % 7).alias("v"))
    new = spark.range(100, 2100).select(F.col("id"), F.when(F.col("id") % 50 == 0, F.lit(-1))
                                         .otherwise(F.col("id") % 7).alias("v"))
    write_bucketed(old, "snap_old", "id", 8, path=f"{tmp}/snap_old")
    write_bucketed(new, "snap_new", "id", 8, path=f"{tmp}/snap_new")
    diff = snapshot_changes(spark.table("snap_old"), spark.table("snap_new"), "id")
    plan = diff._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    got = {r.change_type: r["count"] for r in diff.groupBy("change_type").count().collect()}
    assert got == {"delete": 100, "insert": 100, "update": 38}
