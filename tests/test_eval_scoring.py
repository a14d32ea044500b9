import pytest
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.sql import functions as F

from assetlake.operators import evaluate as V
from assetlake.operators import scoring as SC
from assetlake.operators.train import choose, class_profiles, profile_scores
from assetlake.operators.diagnose import distribution, flags, summary


def test_weighted_f1_matches_spark_ml(spark):
    rows = [(0.0, 0.0), (0.0, 1.0), (1.0, 1.0), (1.0, 1.0), (2.0, 1.0), (2.0, 2.0), (1.0, 0.0)]
    df = spark.createDataFrame(rows, "label double, prediction double")
    ours = V.weighted_f1(df, "label", "prediction").first().weighted_f1
    ml = MulticlassClassificationEvaluator(metricName="weightedFMeasure").evaluate(df)
    assert ours == pytest.approx(ml)
    acc = V.accuracy(df, "label", "prediction").first()
    assert (acc.correct, acc.total) == (4, 7)


def test_per_class_keeps_empty_classes(spark):
    df = spark.createDataFrame([("a", "a"), ("a", "b"), ("b", "b")], "t string, p string")
    classes = spark.createDataFrame([("a",), ("b",), ("c",)], "c string")
    r = {x["class"]: (x.total, x.accuracy) for x in V.per_class(df, "t", "p", classes).collect()}
    assert r == {"a": (2, 0.5), "b": (1, 1.0), "c": (0, None)}
    low = V.low_classes(V.per_class(df, "t", "p", classes)).collect()
    assert low == []  # 0.5 is not below 0.5


def test_top1_ties_and_empty(spark):
    df = spark.createDataFrame(
        [(1, [("x", 0.2), ("y", 0.7), ("z", 0.7)]), (2, []), (3, None)],
        "id int, preds array<struct<label:string,score:double>>")
    got = {r.id: r.t for r in df.select("id", SC.top1("preds").alias("t")).collect()}
    assert got[1].label == "y" and got[1].score == 0.7 and got[2] is None and got[3] is None


def test_gate_and_band(spark):
    df = spark.createDataFrame([(0.3,), (0.30001,), (0.5,), (0.7,), (0.69,)], "s double")
    b, t = SC.band(F.col("s"))
    got = [tuple(r) for r in df.select(SC.gate(F.lit("pizza"), F.col("s")), b, t).collect()]
    assert got[0][0] == SC.GATE_LABEL and got[1][0] == "pizza"
    assert [g[1] for g in got] == ["low", "low", "medium", "high", "medium"]


def test_parse_response_shapes(spark):
    rows = [
        (200, '{"predictions":[{"label":"italian","score":0.9}]}', "italian", 0.9),
        (200, '[{"label":"thai","score":0.8}]', "thai", 0.8),
        (200, '{"label":"mexican","score":0.75}', "mexican", 0.75),
        (200, '{"score":0.6}', "Unknown", 0.6),
        (200, '{"label":"x"}', SC.GATE_LABEL, 0.0),
        (200, '{"label":"x","score":0.3}', SC.GATE_LABEL, 0.3),
        (200, "not json", "Request Error", 0.0),
        (200, '{"label":"x","score":null}', "Error", 0.0),
        (200, '{"label":"x","score":"0.9"}', "Error", 0.0),
        (200, '{"label":null,"score":0.9}', None, 0.9),
        (200, '{"label":"x","score":true}', "x", 1.0),
        (200, '{"predictions":null}', "Error", 0.0),
        (200, '"text"', "Error", 0.0),
        (500, '{"label":"x","score":0.9}', "Error", 0.0),
        (None, None, "Error", 0.0),
        (200, '{"predictions":[]}', "Error", 0.0),
    ]
    df = spark.createDataFrame([(s, b) for s, b, _, _ in rows], "status int, body string")
    got = [(r.label, r.score) for r in SC.parse_responses(df, "status", "body").collect()]
    assert got == [(lbl, sc) for _, _, lbl, sc in rows]


def test_error_kinds(spark):
    rows = [("timeout", "Timeout"), ("connection", "Connection Error"), ("request", "Request Error"), ("odd", "Error"), (None, "x")]
    df = spark.createDataFrame([(200, '{"label":"x","score":0.9}', k) for k, _ in rows], "status int, body string, kind string")
    got = SC.parse_responses(df, "status", "body", error_kind="kind").collect()
    assert [r.label for r in got] == [label for _, label in rows]


def test_profiles_choose_the_better_variant(spark):
    # equal means, different spread: only the likelihood tells the classes apart
    rows = [(i, "wide" if i % 2 else "tight", [(-1.0) ** (i // 2) * (3.0 if i % 2 else 0.1)], i < 40) for i in range(80)]
    df = spark.createDataFrame(rows, "id int, label string, v array<double>, train boolean")
    scored = profile_scores(df, class_profiles(df.where("train"), "label", "v"), "v")
    out = choose(scored, "label", F.col("train")).collect()
    assert len(out) == 40 and {r.variant for r in out} == {"gaussian"}
    assert all(r.pred_label == r.label and 0.5 < r.pred_score <= 1.0 for r in out)


def test_request_json(spark):
    df = spark.createDataFrame([("QUJD",)], "b string")
    assert df.select(SC.request_json("b")).first()[0] == (
        '{"dataframe_split":{"columns":["processed_image_data"],"index":[0],"data":[["QUJD"]]}}')


def test_class_flags(spark):
    rows = [("a",)] * 150 + [("b",)] * 50 + [("c",)] * 49
    dist = distribution(spark.createDataFrame(rows, "c string"), "c")
    s = summary(dist).first()
    assert (s.total, s.min_n, s.max_n, s.smallest_class) == (249, 49, 150, "c")
    f = {r.flag: r.hit for r in flags(summary(dist)).collect()}
    assert f == {"significant_imbalance": True, "very_small_class": True, "small_total": True,
                 "extreme_imbalance": False}


def test_encode_unknown_and_null(spark):
    from assetlake.operators.encode import decode, encode, label_table
    df = spark.createDataFrame([("thai",), ("italian",), ("martian",), (None,)], "c string")
    names = ["thai", "italian", "mexican"]
    got = [r.i for r in encode(df, "c", names, "i").collect()]
    assert got == [2, 0, -1, -1]
    via_table = [r.i for r in encode(df, "c", label_table(spark, names), "i").collect()]
    assert sorted(via_table) == sorted(got)
    back = [r.n for r in decode(encode(df, "c", names, "i"), "i", names, "n").collect()]
    assert back == ["thai", "italian", None, None]


@pytest.mark.parametrize("counts,expect", [
    ({"a": 150, "b": 50}, {"significant_imbalance": False, "very_small_class": False, "small_total": True,
                           "extreme_imbalance": False}),
    ({"a": 151, "b": 50, "c": 300}, {"significant_imbalance": True, "very_small_class": False, "small_total": False,
                                     "extreme_imbalance": True}),
    ({"a": 49, "b": 245, "c": 206}, {"significant_imbalance": True, "very_small_class": True, "small_total": False,
                                     "extreme_imbalance": False}),
])
def test_flag_boundaries(spark, counts, expect):
    rows = [(k,) for k, n in counts.items() for _ in range(n)]
    dist = distribution(spark.createDataFrame(rows, "c string"), "c")
    assert {r.flag: r.hit for r in flags(summary(dist)).collect()} == expect


def test_head_rows_and_report(spark):
    from assetlake.operators.diagnose import head_rows
    df = spark.range(0, 100).withColumn("k", (F.col("id") * 7) % 13)
    assert [r.id for r in head_rows(df, 3, ["k", "id"]).collect()] == [0, 13, 26]
    sc = spark.createDataFrame([("a", "a"), ("b", "a")], "t string, p string")
    rep = V.report(sc, "t", "p")
    assert rep["accuracy"].first().accuracy == 0.5
    assert {r["class"] for r in rep["low_classes"].collect()} == {"b"}
