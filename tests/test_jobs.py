"""End to end: examples -> files -> bronze -> silver -> gold tables, driven by
parameters and config files (SURVEY section 5, item 5)."""

import json
import os

import numpy as np
from pyspark.sql import functions as F

from assetlake.plans import jobs as J
from assetlake.plans.medallion import GOLD_COLUMNS, SILVER_COLUMNS
from assetlake.sinks.tables import current_status
from assetlake.sources.config import Params
from imgutil import png

NAMES = ["apple_pie", "pizza", "ramen", "sushi"]


def _examples(spark):
    rows = []
    for i in range(24):
        label = [1, 2, 3, 0][i % 4]
        img = np.full((40 + i, 48, 3), (i * 10) % 256, np.uint8)
        img[:, :24] = 255 - img[:, :24]  # some contrast
        data = png(img, 2) if i != 9 else b"junk"  # one undecodable example
        rows.append((i, label, bytearray(data)))
    return spark.createDataFrame(rows, "idx bigint, label int, content binary")


def test_jobs_end_to_end(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("jobs")
    cfg, vol = base / "config", base / "volume"
    cfg.mkdir()
    (cfg / "taxonomy.json").write_text(json.dumps({"italian": ["pizza"], "japanese": ["ramen", "sushi"],
                                                    "american": ["apple_pie"]}))
    (cfg / "keys.json").write_text(json.dumps(["apple_pie", "pizza", "ramen", "sushi"]))
    p = Params(config_path=str(cfg), bronze_path=str(vol), bronze_schema="jb", silver_schema="js",
               gold_schema="jg", images_per_key=2, state_path=str(base / "state"))
    ex = _examples(spark)

    status, results = J.ingest_job(spark, p, ex, NAMES, ["pizza", "ramen", "sushi"])
    assert results.filter("error IS NULL").count() == 6
    st = {r.key: (r["count"], r.last_index) for r in current_status(spark, "jb.ingest_status").collect()}
    assert st == {"pizza": (2, 4), "ramen": (2, 5), "sushi": (2, 6)}
    assert sorted(os.listdir(vol / "pizza")) == ["pizza_idx_000000.jpg", "pizza_idx_000004.jpg"]

    # second run continues after the high-water mark (idx 9 is junk bytes, still a file)
    J.ingest_job(spark, p, ex, NAMES, ["pizza", "ramen", "sushi"])
    st = {r.key: (r["count"], r.last_index) for r in current_status(spark, "jb.ingest_status").collect()}
    assert st == {"pizza": (4, 12), "ramen": (4, 13), "sushi": (4, 14)}

    J.bronze_job(spark, p).awaitTermination()
    bronze = spark.table("jb.bronze_assets")
    assert bronze.count() == 12 and {r.food_type for r in bronze.select("food_type").distinct().collect()} == {
        "pizza", "ramen", "sushi"}

    report = {r.rule: (r.checked, r.failed) for r in J.silver_job(spark, p).collect()}
    silver = spark.table("js.silver_assets")
    assert silver.count() == 11  # the junk file fails decoding
    assert sorted(silver.columns) == sorted(SILVER_COLUMNS)
    assert report["valid_image_data"] == (11, 0) and report["good_quality"][0] == 11

    J.gold_job(spark, p)
    g = spark.table("jg.ml_dataset")
    assert g.count() == 11 and sorted(g.columns) == sorted(GOLD_COLUMNS)
    enc = {r.food_type: r.food_type_encoded for r in g.select("food_type", "food_type_encoded").distinct().collect()}
    assert enc == {"pizza": 1, "ramen": 2, "sushi": 3}
    cu = {r.cuisine_category: r.cuisine_category_encoded
          for r in g.select("cuisine_category", "cuisine_category_encoded").distinct().collect()}
    assert cu == {"italian": 1, "japanese": 2}
    assert g.filter(F.col("processed_image_data").isNull()).count() == 0

    # train on the gold statistics, score and evaluate the held-out rows (M1, M3, M7)
    from assetlake.operators.evaluate import report
    from assetlake.operators.train import STAT_FEATURES, feature_vector, fit, score
    feats = feature_vector(g, STAT_FEATURES)
    model = fit(feats.filter("dataset_split = 'train'"), "food_type", max_iter=10)
    scored = score(model, feats.filter("dataset_split != 'train'"))
    rep = report(scored, "food_type", "pred_label")
    acc = rep["accuracy"].first()
    assert acc.total == g.filter("dataset_split != 'train'").count()
    assert set(scored.columns) >= {"pred_label", "pred_score"}
