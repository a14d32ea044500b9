"""Change logs, schema logs, training by epochs, batch inference, rule counts of a stream."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from assetlake.operators import changes as CH
from assetlake.operators import epochs as EP
from assetlake.operators import inference as IN
from assetlake.operators.quality import Rules, report
from assetlake.operators.rank import first_k
from assetlake.sources import schema_log as SL
from assetlake.streaming import checked as CK


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_change_log_replays_versions(spark, tmp):
    schema = "id long, a string, b double"
    versions = [[(1, "x", 1.0), (2, "y", None), (None, "n", 0.0)], [(1, "x", 1.0), (2, "y", 2.0), (3, "z", 3.0)], [(2, "y", 2.0), (4, None, None)], [], [(1, "again", 9.0)]]
    frames = [spark.createDataFrame(v, schema) for v in versions]
    path, before = f"{tmp}/log", spark.createDataFrame([], schema)
    for v, f in enumerate(frames, 1):
        CH.append_changes(CH.changes_between(before, f, "id", v), path)
        before = f
    for v, f in enumerate(frames, 1):
        assert _rows(CH.state_at(spark, path, "id", v)) == _rows(f)
    feed = {(r.id, r.change_type, r.version) for r in CH.read_changes(spark, path, 2, 3).collect()}
    assert feed == {(2, "update", 2), (3, "insert", 2), (None, "delete", 2), (1, "delete", 3), (3, "delete", 3), (4, "insert", 3)}
    # writing a version again, as after a failure, changes nothing
    CH.append_changes(CH.changes_between(frames[1], frames[2], "id", 3), path)
    assert _rows(CH.state_at(spark, path, "id")) == _rows(frames[-1])
    CH.compacted(spark, path, "id", f"{tmp}/compact", 3)
    assert _rows(CH.state_at(spark, f"{tmp}/compact", "id")) == _rows(frames[-1])
    assert {r.version for r in spark.read.parquet(f"{tmp}/compact").select("version").distinct().collect()} <= {3, 4, 5}


def test_repeated_keys_of_a_snapshot_are_one(spark):
    a = spark.createDataFrame([(1, "x"), (1, "y"), (2, "z")], "id long, v string")
    b = spark.createDataFrame([(1, "y"), (1, "a"), (2, "z"), (2, "z")], "id long, v string")
    assert CH.changes_between(a, b, "id", 1).count() == 0


def _texts(spark, texts, first=0):
    return spark.createDataFrame(list(enumerate(texts, first)), "i int, t string")


def test_schema_is_kept_across_runs(spark, tmp):
    log = f"{tmp}/log"
    one = SL.read_kept(_texts(spark, ['{"a": 1, "b": "x"}', '{"a": null}', "not json", None, "[1]", "{}"]), "t", "s", log)
    assert one.columns == ["i", "a", "b", SL.RESCUED] and dict(one.dtypes)["a"] == "bigint"
    assert [tuple(r) for r in one.orderBy("i").collect()] == [(0, 1, "x", None)] + [(i, None, None, None) for i in range(1, 6)]
    two = SL.read_kept(_texts(spark, ['{"a": 2, "c": 1.5, "d": {"e": [1]}}', '{"b": "y"}']), "t", "s", log)
    rows = two.orderBy("i").collect()
    assert two.columns == one.columns and rows[0].a == 2 and rows[0][SL.RESCUED] == {"c": "1.5", "d": '{"e":[1]}'}
    assert (rows[1].a, rows[1].b, rows[1][SL.RESCUED]) == (None, "y", None)
    with pytest.raises(SL.SchemaClash, match="a: bigint is stored, string came"):
        SL.read_kept(_texts(spark, ['{"a": "text"}']), "t", "s", log)
    assert SL.stored(spark, log, "s") == (1, {"a": "bigint", "b": "string"})
    # admitted fields are columns from then on
    assert SL.admit(_texts(spark, ['{"c": 1.5}']), "t", "s", log) == {"a": "bigint", "b": "string", "c": "double"}
    three = SL.read_kept(_texts(spark, ['{"c": 2, "x y": 1}']), "t", "s", log).first()
    assert (three.c, three[SL.RESCUED]) == (2.0, {"x y": "1"}) and SL.stored(spark, log, "s")[0] == 2
    assert SL.stored(spark, log, "other") == (0, {})


def test_schema_of_nothing_and_clashing_names(spark, tmp):
    log = f"{tmp}/log"
    assert SL.read_kept(_texts(spark, []), "t", "s", log).count() == 0 and SL.stored(spark, log, "s") == (0, {})
    own = SL.read_kept(_texts(spark, ['{"i": 7, "q\'s": 1}']), "t", "s", log)
    assert own.columns == ["i", "t.i", "q's", SL.RESCUED] and tuple(own.first())[:3] == (0, 7, 1)


def _training_rows(spark, n=300, width=5):
    rng = np.random.default_rng(0)
    centres = rng.normal(size=(3, width))
    y = rng.integers(0, 3, n)
    x = centres[y] + 0.5 * rng.normal(size=(n, width))
    split = np.where(np.arange(n) % 5 == 0, "validation", np.where(np.arange(n) % 7 == 0, "test", "train"))
    return [("abc"[c], v.tolist(), s) for c, v, s in zip(y, x, split)], width


SCHEMA = "label string, x array<double>, split string"


def test_epochs_follow_gradient_descent(spark, tmp):
    rows, width = _training_rows(spark)
    odd = [(None, [0.0] * width, "train"), ("z", [0.0] * width, "train"), ("a", None, "train"), ("a", [1.0], "train"), ("a", [float("nan")] * width, "train")]
    settings = EP.Settings(epochs=4, rate=0.7, decay=0.05)
    history = EP.run_epochs(spark.createDataFrame(rows + odd, SCHEMA), "label", "x", ["a", "b", "c"], width, f"{tmp}/w", settings)
    got = sorted(history.collect())
    part = {s: [(("abc".index(c)), v) for c, v, k in rows if k == s] for s in ("train", "validation")}
    arrays = {s: (np.array([c for c, _ in p]), np.hstack([np.array([v for _, v in p]), np.ones((len(p), 1))])) for s, p in part.items()}
    w = np.zeros((3, width + 1))
    for epoch in range(5):
        if epoch:
            y, x = arrays["train"]
            p = EP.probabilities(x, w)
            p[np.arange(len(y)), y] -= 1
            decay = settings.decay * w
            decay[:, -1] = 0
            w = w - settings.rate * (p.T @ x / len(y) + decay)
        for s, column in (("train", 1), ("validation", 2)):
            y, x = arrays[s]
            assert got[epoch][column] == pytest.approx(-np.log(EP.probabilities(x, w)[np.arange(len(y)), y]).mean(), rel=1e-9)
    assert [r.chosen for r in got] == [r.eval_loss == min(q.eval_loss for q in got) for r in got]
    assert EP.best_weights(spark, f"{tmp}/w", history, ["a", "b", "c"]) == pytest.approx(w if got[-1].chosen else w, rel=1e-9)
    # a run over the same path goes on from the stored epochs
    more = EP.run_epochs(spark.createDataFrame(rows, SCHEMA), "label", "x", ["a", "b", "c"], width, f"{tmp}/w", EP.Settings(5, 0.05, 0.7))
    assert [r.train_loss for r in sorted(more.collect())[:5]] == pytest.approx([r.train_loss for r in got])


def test_epochs_without_rows(spark, tmp):
    history = EP.run_epochs(spark.createDataFrame([], SCHEMA), "label", "x", ["a", "b"], 2, f"{tmp}/w", EP.Settings(1, 0.0, 1.0)).collect()
    assert [(r.train_loss, r.eval_loss) for r in history] == [(None, None)] * 2 and history[1].chosen


def test_batch_inference(spark):
    rng = np.random.default_rng(1)
    w = rng.normal(size=(4, 6))
    x = rng.uniform(0, 255, size=(50, 5))
    d = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)] + [(90, None), (91, [1.0]), (92, [None] * 5)], "i int, v array<double>")
    mean, std = [0.1, 0.2, 0.3, 0.4, 0.5], [0.5, 0.6, 0.7, 0.8, 0.9]
    model = IN.classifier(lambda: (w, list("abcd")), 5, mean, std, 255.0)
    rows = {r.i: r for r in IN.score(d, "v", model, list("abcd"), 5).collect()}
    z = (x / 255.0 - mean) / std @ w[:, :-1].T + w[:, -1]
    p = np.exp(z) / np.exp(z).sum(1, keepdims=True)
    for i in range(50):
        assert rows[i].pred_label == "abcd"[p[i].argmax()] and rows[i].pred_score == pytest.approx(p[i].max(), rel=1e-9)
    assert all(rows[i].pred_label is None and rows[i].pred_score is None for i in (90, 91, 92))
    assert IN.score(d.limit(0), "v", model, list("abcd"), 5).count() == 0


def test_stream_counts_survive_restarts(spark, tmp):
    rules = Rules(drop={"positive": "v > 0", "named": "name IS NOT NULL"}, warn={"small": "v < 50"})
    schema = "v int, name string"
    source, counts = f"{tmp}/in", f"{tmp}/counts"
    batches = [[(i - 5, "x" if i % 4 else None) for i in range(30 * k, 30 * k + 30)] for k in range(4)]

    def run(more):
        for b in more:
            spark.createDataFrame(b, schema).coalesce(1).write.mode("append").parquet(source)
        rows = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source)
        query, listener = CK.start_checked(rows, rules, f"{tmp}/out", f"{tmp}/ck", counts, "checked-rows")
        CK.finish(query, listener)

    run(batches[:2])
    first = {r.rule: (r.checked, r.failed) for r in CK.summed(spark, counts).collect()}
    assert first["positive"][0] == 60
    run(batches[2:])  # a restart from the checkpoint
    run([])
    everything = spark.createDataFrame([r for b in batches for r in b], schema)
    want = {r.rule: (r.action, r.checked, r.failed) for r in report(everything, rules).collect()}
    assert {r.rule: (r.action, r.checked, r.failed) for r in CK.summed(spark, counts).collect()} == want
    assert spark.read.parquet(f"{tmp}/out").count() == everything.where("v > 0 AND name IS NOT NULL").count()


def test_first_k_inside_a_crowded_place(spark, monkeypatch):
    """A third of all rows share one value, and more share its leading digits."""
    from assetlake.operators import rank
    monkeypatch.setattr(rank, "SMALL", 50)
    df = spark.range(0, 3000).select("id", F.when(F.col("id") % 3 == 0, F.lit(0.25)).when(F.col("id") % 3 == 1, 0.25 + F.col("id") / 2.0 ** 45)
                                     .otherwise(F.col("id") / 3000.0).alias("u")).withColumn("id", F.when(F.col("id") % 600 != 0, F.col("id")))
    rows = sorted(((r.u, r.id is not None, r.id or 0) for r in df.collect()))
    for k in (1, 700, 1000, 1500, 2200, 2999):
        got = sorted((r.u, r.id is not None, r.id or 0) for r in first_k(df, "u", ["id"], k, "chosen").where("chosen").collect())
        assert got == rows[:k], k
