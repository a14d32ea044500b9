import pytest
from pyspark.sql import functions as F

from assetlake.operators.train import feature_vector, fit, save, score
from assetlake.sinks.tables import log_run, metric_rows, register_model, views_by, write_partitioned
from assetlake.sources.tables import tables_with_prefix, union_tables


def test_discovery_and_union(spark):
    for g in ["italian", "thai"]:
        spark.createDataFrame([(g, 1), (g, 2)], "g string, v int").write.mode("overwrite").saveAsTable(f"cuisine_{g}")
    spark.createDataFrame([("x", 1)], "g string, v int").write.mode("overwrite").saveAsTable("other_x")
    assert tables_with_prefix(spark, "cuisine_") == ["cuisine_italian", "cuisine_thai"]
    assert union_tables(spark, "cuisine_").count() == 4
    with pytest.raises(ValueError):
        tables_with_prefix(spark, "nothing_")


def test_partitioned_write_views_and_props(spark, tmp):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "key string, v int")
    write_partitioned(df, "bronze_assets", ["key"], comment="bronze", properties={"layer": "bronze"},
                      path=f"{tmp}/bronze_assets")
    names = views_by(spark, "bronze_assets", "key", ["a", "b"], "food_")
    assert names == ["food_a", "food_b"] and spark.table("food_a").count() == 2
    odd = "it's \\ a-b"
    spark.createDataFrame([(odd, 1), ("a", 2)], "key string, v int").createOrReplaceTempView("odd_assets")
    views_by(spark, "odd_assets", "key", [odd], "food_")
    assert [r.v for r in spark.table("`food_" + odd + "`").collect()] == [1]
    props = {r.key: r.value for r in spark.sql("SHOW TBLPROPERTIES bronze_assets").collect()}
    assert props.get("layer") == "bronze"


def test_metric_rows_drop_non_numeric(spark):
    m = spark.createDataFrame([(0.5, "x", 3)], "accuracy double, note string, n bigint")
    rows = metric_rows([m], {"epochs": "5"})
    got = {(r.kind, r.name) for r in rows.collect()}
    assert got == {("metric", "accuracy"), ("metric", "n"), ("param", "epochs")}
    log_run(rows, "runs", "r1")
    assert spark.table("runs").filter("run_id = 'r1'").count() == 3


def test_train_score_save_register(spark, tmp):
    rows = [(float(i % 2), float(i % 2) * 2 + 0.1 * (i % 5), "even" if i % 2 == 0 else "odd") for i in range(60)]
    df = spark.createDataFrame(rows, "a double, b double, label string")
    df = feature_vector(df, ["a", "b"])
    model = fit(df, "label", max_iter=20)
    s = score(model, df)
    acc = s.filter(F.col("pred_label") == F.col("label")).count() / s.count()
    assert acc > 0.9
    save(model, f"{tmp}/model")
    assert register_model(spark, "models", "clf", f"{tmp}/model", "champion", {"task": "classify"}) == 1
    assert register_model(spark, "models", "clf", f"{tmp}/model") == 2
