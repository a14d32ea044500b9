"""Scoring and image-statistics queries.

embeddings stand in for score vectors and single-channel pixel rows;
events carry a confidence (value / 500) and the responses built from them.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from assetlake.functions import columns as C
from assetlake.operators import images as IM
from assetlake.operators import scoring as SC
from assetlake.operators.evaluate import argmax as argmax_col
from assetlake.operators.train import VARIANCE_FLOOR
from assetlake.plans.registry import r6, register, split_case, uhash
from assetlake.sources.tables import read_table


def _preds(spark, d):
    e = read_table(spark, d, "embeddings").select("vec_id", "embedding")
    preds = F.transform("embedding", lambda x, i: F.struct(F.concat(F.lit("c"), i.cast("string")).alias("label"),
                                                           x.cast("double").alias("score")))
    return e.select("vec_id", "embedding", preds.alias("preds"))


def top1(spark, d):
    t = _preds(spark, d).select("vec_id", SC.top1("preds").alias("t"))
    return t.select("vec_id", F.col("t.label").alias("label"), C.round6("t.score").alias("score"))


register("top1", f"""
SELECT vec_id, 'c' || CAST(list_position(embedding, list_max(embedding)) - 1 AS VARCHAR) AS label,
       {r6('list_max(embedding)::DOUBLE')} AS score
FROM embeddings
""")(top1)


def argmax(spark, d):
    e = read_table(spark, d, "embeddings").select("vec_id", "embedding")
    return e.select("vec_id", argmax_col("embedding").alias("argmax"))


register("argmax", """
SELECT vec_id, CAST(list_position(embedding, list_max(embedding)) - 1 AS INTEGER) AS argmax FROM embeddings
""")(argmax)


def confidence_gate_band(spark, d):
    ev = read_table(spark, d, "events").select("event_id", "event_type", "value")
    score = F.col("value") / F.lit(500.0)
    band, text = SC.band(score)
    pct = F.floor(score * F.lit(1000.0) + F.lit(0.5)) / F.lit(10.0)
    return ev.select("event_id",
                     C.title(SC.gate(F.col("event_type"), score)).alias("label"),
                     band.alias("band"), text.alias("band_text"),
                     pct.alias("pct"),
                     C.percent_text(pct / F.lit(100.0)).alias("pct_text"))


register("confidence_gate_band", """
WITH s AS (SELECT event_id, event_type, value / 500.0::DOUBLE AS score FROM events),
p AS (SELECT *, score * 100.0::DOUBLE AS pct100, floor(score * 1000.0::DOUBLE + 0.5::DOUBLE) / 10.0::DOUBLE AS pct FROM s)
SELECT event_id,
       CASE WHEN score <= 0.3 THEN 'Not A Food / Unknown Image Data'
            ELSE upper(substr(event_type, 1, 1)) || lower(substr(event_type, 2)) END AS label,
       CASE WHEN pct100 >= 70 THEN 'high' WHEN pct100 >= 50 THEN 'medium' ELSE 'low' END AS band,
       CASE WHEN pct100 >= 70 THEN 'Excellent' WHEN pct100 >= 50 THEN 'Good' ELSE 'Uncertain' END AS band_text,
       pct, printf('%.1f%%', pct) AS pct_text
FROM p
""")(confidence_gate_band)


def request_json(spark, d):
    ev = read_table(spark, d, "events").select("event_id", "event_type")
    payload = C.b64(F.encode(F.concat("event_type", F.lit(":"), F.col("event_id").cast("string")), "UTF-8"))
    return ev.select("event_id", SC.request_json(payload).alias("request"))


register("request_json", """
SELECT event_id,
       json_object('dataframe_split', json_object('columns', ['processed_image_data'], 'index', [0],
                   'data', [[to_base64(encode(event_type || ':' || CAST(event_id AS VARCHAR)))]]))::VARCHAR AS request
FROM events
""")(request_json)


def _responses(spark, d):
    """Stored responses derived from events: six body shapes, some failures."""
    ev = read_table(spark, d, "events").select("event_id", "event_type")
    s = F.concat(F.lit("0."), F.lpad((F.col("event_id") % 1000).cast("string"), 3, "0"))
    lbl = F.concat(F.lit('"label":"'), F.col("event_type"), F.lit('"'))
    sc = F.concat(F.lit('"score":'), s)
    m = F.col("event_id") % 12
    body = (F.when(m == 0, F.concat(F.lit('{"predictions":[{'), lbl, F.lit(","), sc, F.lit("}]}")))
            .when(m == 1, F.concat(F.lit("[{"), lbl, F.lit(","), sc, F.lit("}]")))
            .when(m == 2, F.concat(F.lit("{"), lbl, F.lit(","), sc, F.lit("}")))
            .when(m == 3, F.concat(F.lit("{"), sc, F.lit("}")))
            .when(m == 4, F.concat(F.lit("{"), lbl, F.lit("}")))
            .when(m == 5, F.lit('{"predictions":[]}'))
            .when(m == 6, F.concat(F.lit("{"), lbl, F.lit(',"score":null}')))
            .when(m == 7, F.concat(F.lit("{"), lbl, F.lit(',"score":"0.9"}')))
            .when(m == 8, F.concat(F.lit(' [{"label":null,'), sc, F.lit("}]")))
            .when(m == 9, F.concat(F.lit("{"), lbl, F.lit(',"score":true}')))
            .when(m == 10, F.lit("[]"))
            .otherwise(F.concat(F.lit("oops "), F.col("event_type"))))
    status = F.when(F.col("event_id") % 50 == 7, F.lit(500)).otherwise(F.lit(200))
    k = F.col("event_id") % 60
    kind = (F.when(k == 9, F.lit("timeout")).when(k == 11, F.lit("connection"))
            .when(k == 13, F.lit("request")).when(k == 17, F.lit("other")))
    return ev.select("event_id", status.alias("status"), body.alias("body"), kind.alias("error_kind"))


_RESP_SQL = """r0 AS (SELECT event_id, event_type, '0.' || lpad(CAST(event_id % 1000 AS VARCHAR), 3, '0') AS s FROM events),
r AS (SELECT event_id,
             CASE WHEN event_id % 50 = 7 THEN 500 ELSE 200 END AS status,
             CASE event_id % 60 WHEN 9 THEN 'timeout' WHEN 11 THEN 'connection' WHEN 13 THEN 'request' WHEN 17 THEN 'other' END AS kind,
             CASE event_id % 12
               WHEN 0 THEN '{"predictions":[{"label":"' || event_type || '","score":' || s || '}]}'
               WHEN 1 THEN '[{"label":"' || event_type || '","score":' || s || '}]'
               WHEN 2 THEN '{"label":"' || event_type || '","score":' || s || '}'
               WHEN 3 THEN '{"score":' || s || '}'
               WHEN 4 THEN '{"label":"' || event_type || '"}'
               WHEN 5 THEN '{"predictions":[]}'
               WHEN 6 THEN '{"label":"' || event_type || '","score":null}'
               WHEN 7 THEN '{"label":"' || event_type || '","score":"0.9"}'
               WHEN 8 THEN ' [{"label":null,"score":' || s || '}]'
               WHEN 9 THEN '{"label":"' || event_type || '","score":true}'
               WHEN 10 THEN '[]'
               ELSE 'oops ' || event_type END AS body FROM r0),
j AS (SELECT *, json_valid(body) AS okj, CASE WHEN json_valid(body) THEN body::JSON END AS v FROM r),
k AS (SELECT *, CASE WHEN json_type(v) = 'OBJECT' AND json_exists(v, '$.predictions') THEN json_extract(v, '$.predictions[0]')
                     WHEN json_type(v) = 'ARRAY' THEN json_extract(v, '$[0]') ELSE v END AS pred FROM j),
m AS (SELECT *, coalesce(json_type(pred) = 'OBJECT', false) AS pok,
             CASE WHEN NOT json_exists(pred, '$.score') THEN 0.0::DOUBLE
                  WHEN json_type(pred, '$.score') = 'BOOLEAN' THEN CAST(CAST(json_extract_string(pred, '$.score') AS BOOLEAN) AS INT)::DOUBLE
                  WHEN json_type(pred, '$.score') IN ('UBIGINT', 'BIGINT', 'DOUBLE') THEN CAST(json_extract_string(pred, '$.score') AS DOUBLE) END AS sc,
             CASE WHEN json_exists(pred, '$.label') THEN json_extract_string(pred, '$.label') ELSE 'Unknown' END AS lb FROM k),
parsed AS (SELECT event_id, status,
       CASE WHEN kind = 'timeout' THEN 'Timeout' WHEN kind = 'connection' THEN 'Connection Error'
            WHEN kind = 'request' THEN 'Request Error' WHEN kind IS NOT NULL THEN 'Error'
            WHEN status IS DISTINCT FROM 200 THEN 'Error' WHEN NOT okj THEN 'Request Error'
            WHEN NOT pok OR sc IS NULL THEN 'Error'
            WHEN sc <= 0.3 THEN 'Not a food / Unknown image data' ELSE lb END AS label,
       CASE WHEN kind IS NULL AND status = 200 AND okj AND pok THEN coalesce(sc, 0.0::DOUBLE) ELSE 0.0::DOUBLE END AS score FROM m)"""


def response_parse(spark, d):
    r = SC.parse_responses(_responses(spark, d), "status", "body", error_kind="error_kind")
    return r.select("event_id", "status", "label", C.round6("score").alias("score"))


register("response_parse", f"""WITH {_RESP_SQL}
SELECT event_id, status, label, {r6('score')} AS score FROM parsed
""")(response_parse)


def response_errors(spark, d):
    r = SC.parse_responses(_responses(spark, d), "status", "body", error_kind="error_kind")
    g = r.groupBy("label").agg(F.count(F.lit(1)).cast("bigint").alias("n"))
    return g.withColumn("shown", SC.shown(F.col("label")))


register("response_errors", f"""WITH {_RESP_SQL}
SELECT label, CAST(count(*) AS BIGINT) AS n, coalesce(label NOT IN ('Error', 'Timeout', 'Connection Error'), true) AS shown
FROM parsed GROUP BY label
""")(response_errors)


# ---------------------------------------------------------------- pixel statistics and geometry

def vector_stats(spark, d):
    e = read_table(spark, d, "embeddings").select("vec_id", "embedding")
    st = IM.with_channel_stats(e, "embedding", "_m", "_sd")
    return st.select("vec_id", C.round6("_m").alias("mean"), C.round6("_sd").alias("std"),
                     C.round6(IM.quality_score(F.col("_sd"))).alias("quality_score"))


_VS = """v AS (SELECT vec_id, embedding, list_sum(list_transform(embedding, lambda x: x::DOUBLE)) / len(embedding) AS m FROM embeddings),
w AS (SELECT vec_id, m, sqrt(list_sum(list_transform(embedding, lambda x: (x::DOUBLE - m) * (x::DOUBLE - m))) / len(embedding)) AS sd FROM v)"""

register("vector_stats", f"""WITH {_VS}
SELECT vec_id, {r6('m')} AS mean, {r6('sd')} AS std, {r6('least(1.0::DOUBLE, sd * 2.0::DOUBLE)')} AS quality_score FROM w
""")(vector_stats)


def letterbox_geometry(spark, d):
    p = read_table(spark, d, "part").select("p_partkey", "p_size")
    w = (F.lit(32) + F.col("p_size")).cast("int")
    h = (F.lit(32) + F.col("p_partkey") % 500).cast("int")
    g = IM.letterbox(w, h, 224)
    return p.select("p_partkey", w.alias("w"), h.alias("h"), C.round6(g["aspect"]).alias("aspect"),
                    g["new_w"].alias("new_w"), g["new_h"].alias("new_h"),
                    g["off_x"].alias("off_x"), g["off_y"].alias("off_y"))


register("letterbox_geometry", f"""
WITH g AS (SELECT p_partkey, CAST(32 + p_size AS INTEGER) AS w, CAST(32 + p_partkey % 500 AS INTEGER) AS h FROM part),
a AS (SELECT *, w::DOUBLE / h AS aspect FROM g),
n AS (SELECT *, CASE WHEN aspect > 1 THEN 224 ELSE CAST(trunc(224 * aspect) AS INTEGER) END AS new_w,
               CASE WHEN aspect > 1 THEN CAST(trunc(224 / aspect) AS INTEGER) ELSE 224 END AS new_h FROM a)
SELECT p_partkey, w, h, {r6('aspect')} AS aspect, new_w, new_h,
       CAST((224 - new_w) // 2 AS INTEGER) AS off_x, CAST((224 - new_h) // 2 AS INTEGER) AS off_y FROM n
""")(letterbox_geometry)


def size_gate(spark, d):
    p = read_table(spark, d, "part").select("p_partkey", "p_size")
    w = (F.col("p_size") * 90).cast("int")
    h = (F.lit(16) + F.col("p_partkey") % 5000).cast("int")
    ch = (F.lit(1) + F.col("p_partkey") % 4).cast("int")
    return p.select("p_partkey", w.alias("w"), h.alias("h"), ch.alias("channels"),
                    IM.valid_size(w, h).alias("size_ok"),
                    IM.valid_image(w, h, IM.mode_from_channels(ch)).alias("valid"))


register("size_gate", """
WITH g AS (SELECT p_partkey, CAST(p_size * 90 AS INTEGER) AS w, CAST(16 + p_partkey % 5000 AS INTEGER) AS h,
                  CAST(1 + p_partkey % 4 AS INTEGER) AS channels FROM part)
SELECT p_partkey, w, h, channels,
       w BETWEEN 32 AND 4096 AND h BETWEEN 32 AND 4096 AS size_ok,
       w BETWEEN 32 AND 4096 AND h BETWEEN 32 AND 4096 AND channels IN (1, 3, 4) AS valid
FROM g
""")(size_gate)


# ---------------------------------------------------------------- training and batch scoring

def train_score(spark, d):
    """M3 + M1: fit two closed-form classifiers on the train split of the
    embeddings (vector -> label name), keep the one that does better on the
    validation split and score the test split with it."""
    from assetlake.operators.split import split_hash
    from assetlake.operators.train import choose, class_profiles, profile_scores

    e = read_table(spark, d, "embeddings").select(
        "vec_id", "embedding", F.concat(F.lit("c"), F.col("label").cast("string")).alias("label"))
    e = split_hash(e, "vec_id", 42)
    profiles = class_profiles(e.filter(F.col("dataset_split") == "train"), "label", "embedding")
    scored = profile_scores(e.filter(F.col("dataset_split") != "train"), profiles, "embedding")
    s = choose(scored, "label", F.col("dataset_split") == "validation")
    return s.select("vec_id", "label", "variant", "pred_label", C.round6("pred_score").alias("pred_score"))


_TRAIN_SQL = f"""e AS (SELECT vec_id, embedding, 'c' || CAST(label AS VARCHAR) AS label, {split_case(uhash(42, 'vec_id'))} AS split FROM embeddings),
x AS (SELECT vec_id, label, split, unnest(embedding)::DOUBLE AS x, unnest(range(len(embedding))) AS i FROM e),
p AS (SELECT label, i, count(*) AS n, avg(x) AS m, var_pop(x) + {VARIANCE_FLOOR}::DOUBLE AS v FROM x WHERE split = 'train' GROUP BY label, i),
s AS (SELECT x.vec_id, x.label, x.split, p.label AS c, -sum((x - m) * (x - m)) AS means,
             ln(max(n)::DOUBLE / (SELECT count(*) FROM e WHERE split = 'train')) - 0.5::DOUBLE * sum(ln(v) + (x - m) * (x - m) / v) AS gaussian
      FROM x JOIN p ON x.i = p.i WHERE x.split <> 'train' GROUP BY x.vec_id, x.label, x.split, p.label),
t AS (SELECT *, max(means) OVER w AS tm, max(gaussian) OVER w AS tg FROM s WINDOW w AS (PARTITION BY vec_id)),
b AS (SELECT vec_id, label, split, min(c) FILTER (WHERE means = tm) AS lm, 1.0::DOUBLE / sum(exp(means - tm)) AS sm,
             min(c) FILTER (WHERE gaussian = tg) AS lg, 1.0::DOUBLE / sum(exp(gaussian - tg)) AS sg
      FROM t GROUP BY vec_id, label, split),
best AS (SELECT CASE WHEN count(*) FILTER (WHERE lg = label) > count(*) FILTER (WHERE lm = label) THEN 'gaussian' ELSE 'means' END AS variant
         FROM b WHERE split = 'validation'),
chosen AS (SELECT vec_id, label, variant, CASE variant WHEN 'gaussian' THEN lg ELSE lm END AS pred_label,
             CASE variant WHEN 'gaussian' THEN sg ELSE sm END AS pred_score FROM b, best WHERE split = 'test')"""

register("train_score", f"""WITH {_TRAIN_SQL}
SELECT vec_id, label, variant, pred_label, {r6('pred_score')} AS pred_score FROM chosen
""")(train_score)


def heldout_per_class(spark, d):
    """M7: per-class accuracy of the chosen classifier on the test rows,
    every class of the label list kept."""
    from assetlake.operators.evaluate import per_class
    classes = read_table(spark, d, "embeddings").select(
        F.concat(F.lit("c"), F.col("label").cast("string")).alias("class")).distinct()
    per = per_class(train_score(spark, d), "label", "pred_label", classes)
    return per.select("class", "correct", "total", C.round6("accuracy").alias("accuracy"))


register("heldout_per_class", f"""WITH {_TRAIN_SQL},
g AS (SELECT label, count(*) AS total, count(*) FILTER (WHERE label = pred_label) AS correct FROM chosen GROUP BY label)
SELECT c.label AS class, CAST(coalesce(g.correct, 0) AS BIGINT) AS correct, CAST(coalesce(g.total, 0) AS BIGINT) AS total,
       CASE WHEN g.total > 0 THEN {r6('g.correct::DOUBLE / g.total')} END AS accuracy
FROM (SELECT DISTINCT label FROM e) c LEFT JOIN g ON c.label = g.label
""")(heldout_per_class)
