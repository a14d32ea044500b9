"""Plan-shape checks: the properties the design relies on at scale."""

import pytest

import __spark_entry__ as E
from conftest import SF001


def _plan(spark, name):
    df = E.queries()[name](spark, SF001)
    df.write.format("noop").mode("overwrite").save()  # final adaptive plan
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(E.queries()) - set(E.LLM_QUERIES)))
def test_no_cartesian_or_nested_loop(spark, name):
    p = _plan(spark, name)
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


@pytest.mark.parametrize("name", ["gold_dataset", "path_parts", "split_hash", "label_encode", "request_json",
                                  "response_parse", "vector_stats", "asset_id", "binary_size_base64"])
def test_narrow_queries_do_not_shuffle(spark, name):
    assert "Exchange" not in _plan(spark, name)


def test_top_n_per_key_is_partial_before_shuffle(spark):
    p = _plan(spark, "ingest_plan")
    assert p.count("WindowGroupLimit") >= 2  # partial (map side) + final


def test_pushdown_and_pruning(spark):
    df = E.queries()["gold_dataset"](spark, SF001)
    text = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(text)]" in text
    assert "ReadSchema: struct<doc_id:bigint,text:string,lang:string,source:string>" in text


def test_silver_does_not_read_bronze_content(spark, tmp_path):
    import numpy as np
    from assetlake.plans.medallion import bronze, silver_rows
    from assetlake.sources.files import binary_files, decoded_images
    from imgutil import png, write

    root = tmp_path / "vol"
    write(f"{root}/pizza/pizza_idx_000001.png", png(np.zeros((40, 40, 3), np.uint8), 2))
    b = bronze(binary_files(spark, str(root)), key_from_dir=True)
    b.write.mode("overwrite").parquet(str(tmp_path / "bronze"))
    table = spark.read.parquet(str(tmp_path / "bronze"))
    tax = spark.createDataFrame([("pizza", "italian")], "key string, group string")
    rows = silver_rows(table, decoded_images(spark, str(root)), tax)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "ReadSchema" in line or "FileScan parquet" in line]
    assert scans and all("content:binary" not in line for line in scans)
    assert rows.count() == 1
