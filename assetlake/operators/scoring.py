"""Scoring results: top-1, gates, bands, request/response JSON.

The serving endpoint is not called; its stored responses are parsed. JSON
work uses ``try_parse_json`` (VARIANT) so a bad body yields NULL instead of
failing the batch.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the surveyed app.
GATE_SCORE = 0.3
GATE_LABEL = "Not a food / Unknown image data"
UNKNOWN_LABEL = "Unknown"
CONFIDENCE_BANDS = [(70.0, "high", "Excellent"), (50.0, "medium", "Good")]
LOW_BAND = ("low", "Uncertain")
ERROR_LABELS = {"timeout": "Timeout", "connection": "Connection Error", "request": "Request Error"}
NOT_SHOWN = ["Error", "Timeout", "Connection Error"]


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def top1(preds) -> Column:
    """The highest-score element of array<struct<label, score>>; first on ties.

    ``array_max`` over (score, -position, label) structs: the larger score
    wins, then the smaller position. Empty or null list -> null.
    """
    p = _c(preds)
    keyed = F.transform(p, lambda e, i: F.struct(e["score"].alias("s"), (-i).alias("np"), e["label"].alias("label")))
    best = F.array_max(keyed)
    return F.when(F.size(p) > 0, F.struct(best["label"].alias("label"), best["s"].alias("score")))


def gate(label, score) -> Column:
    """M4: scores at or below the gate get the unknown-image label."""
    return F.when(_c(score) <= F.lit(GATE_SCORE), F.lit(GATE_LABEL)).otherwise(_c(label))


def band(score) -> tuple[Column, Column]:
    """M5: (band, text) from pct = 100 * score."""
    pct = _c(score) * F.lit(100.0)
    b = t = None
    for edge, name, text in CONFIDENCE_BANDS:
        b = F.when(pct >= F.lit(edge), F.lit(name)) if b is None else b.when(pct >= F.lit(edge), F.lit(name))
        t = F.when(pct >= F.lit(edge), F.lit(text)) if t is None else t.when(pct >= F.lit(edge), F.lit(text))
    return b.otherwise(F.lit(LOW_BAND[0])), t.otherwise(F.lit(LOW_BAND[1]))


def request_json(payload_b64, column_name: str = "processed_image_data") -> Column:
    """``{"dataframe_split": {"columns": [..], "index": [0], "data": [[b64]]}}``."""
    inner = F.struct(F.array(F.lit(column_name)).alias("columns"),
                     F.array(F.lit(0)).alias("index"),
                     F.array(F.array(_c(payload_b64))).alias("data"))
    return F.to_json(F.struct(inner.alias("dataframe_split")))


def parse_responses(df: DataFrame, status: str, body: str, label_out: str = "label",
                    score_out: str = "score", error_kind: str | None = None) -> DataFrame:
    """Add (label, score) parsed from stored responses.

    ``error_kind`` names a column that tells why no response came back (null:
    one did); a non-200 status is ('Error', 0.0), a body that is not JSON
    ('Request Error', 0.0): the client library counts it among its request
    exceptions. Else ``predictions[0]``, or the first list element, or the
    object. A missing label is 'Unknown' (a null one stays null), a missing
    score 0.0; a prediction that is not an object, or a score that is null,
    text, a list or an object, is an error, as comparing it with the gate fails.

    The JSON is parsed once into a VARIANT column and each later step reads
    that column: written as one nested expression, Catalyst inlines the
    prediction sub-expression into every use and parses it again.
    """
    first = F.substring(F.ltrim(F.col(body), F.lit(" \t\r\n")), 1, 1)
    t = df.withColumn("_v", F.try_parse_json(F.col(body))).withColumn("_c", first)
    has_preds = (F.col("_c") == "{") & F.try_variant_get("_v", "$.predictions", "variant").isNotNull()
    t = t.withColumn("_p", F.when(has_preds, F.try_variant_get("_v", "$.predictions[0]", "variant"))
                     .when(F.col("_c") == "[", F.try_variant_get("_v", "$[0]", "variant"))
                     .otherwise(F.col("_v")))
    t = (t.withColumn("_pok", F.try_variant_get("_p", "$", "map<string,variant>").isNotNull())
         .withColumn("_has", F.try_variant_get("_p", "$.label", "variant").isNotNull())
         .withColumn("_lb", F.try_variant_get("_p", "$.label", "string"))
         .withColumn("_s", F.try_variant_get("_p", "$.score", "variant")))
    kind = F.schema_of_variant("_s")
    number = (kind == "BOOLEAN") | (kind == "BIGINT") | (kind == "DOUBLE") | kind.startswith("DECIMAL")
    t = t.withColumn("_sc", F.when(F.col("_s").isNull(), F.lit(0.0))
                     .when(number, F.try_variant_get("_s", "$", "double")))
    ok = F.coalesce(F.col(status) == F.lit(200), F.lit(False))
    good = ok & F.col("_pok") & F.col("_sc").isNotNull()
    if error_kind is not None:
        good = good & F.col(error_kind).isNull()
    named = F.when(F.col("_has"), F.col("_lb")).otherwise(F.lit(UNKNOWN_LABEL))
    label = F.when(good, gate(named, F.col("_sc"))).when(ok & F.col("_v").isNull(), F.lit(ERROR_LABELS["request"])).otherwise(F.lit("Error"))
    if error_kind is not None:
        failed = F.create_map(*[F.lit(x) for pair in ERROR_LABELS.items() for x in pair])
        label = F.when(F.col(error_kind).isNotNull(), F.coalesce(F.try_element_at(failed, F.col(error_kind)), F.lit("Error"))).otherwise(label)
    t = t.withColumn(label_out, label).withColumn(score_out, F.when(good, F.col("_sc")).otherwise(F.lit(0.0)))
    return t.drop("_v", "_c", "_p", "_pok", "_has", "_lb", "_s", "_sc")


def shown(label) -> Column:
    """M6: results the app displays (three error labels are not)."""
    return F.coalesce(~_c(label).isin(NOT_SHOWN), F.lit(True))
