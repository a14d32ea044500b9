"""Queries over state that runs leave behind: change logs, schema logs, weights by epoch."""

from __future__ import annotations

import uuid

import numpy as np
from pyspark.sql import functions as F

from assetlake.functions.columns import round6
from assetlake.operators import changes as CH
from assetlake.operators import epochs as EP
from assetlake.operators import inference as IN
from assetlake.operators.rank import unit_hash
from assetlake.operators.split import split_label
from assetlake.plans.registry import r6, register, split_case, uhash
from assetlake.session import scratch_path
from assetlake.sources.schema_log import RESCUED, admit, read_kept
from assetlake.sources.tables import read_table


def _fresh(spark, name: str) -> str:
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex}")


# ---------------------------------------------------------------- change log (K6)

# Three versions of the orders: the first cut-off, then more orders with some closed and some archived.
CUTS = ["1998-01-01", "2001-01-01", "2100-01-01"]
_ORDER = ["o_orderkey", "o_orderstatus", "o_totalprice"]


def _version(orders, v: int):
    """Version v (1..3): orders before its cut-off; later ones raise prices and archive some finished orders."""
    df = orders.where(F.col("o_orderdate") < F.lit(CUTS[v - 1]).cast("timestamp_ntz"))
    if v > 1:
        df = df.where(~((F.col("o_orderstatus") == "F") & (F.col("o_orderkey") % (v + 1) == 0)))
        df = df.withColumn("o_totalprice", F.when(F.col("o_orderkey") % 5 == v, F.col("o_totalprice") + v).otherwise(F.col("o_totalprice")))
    return df.select(*_ORDER)


def _version_sql(v: int) -> str:
    price = "o_totalprice" if v == 1 else f"CASE WHEN o_orderkey % 5 = {v} THEN o_totalprice + {v} ELSE o_totalprice END"
    gone = "" if v == 1 else f" AND NOT (o_orderstatus = 'F' AND o_orderkey % {v + 1} = 0)"
    return f"SELECT o_orderkey, o_orderstatus, {price} AS o_totalprice FROM orders WHERE o_orderdate < TIMESTAMP '{CUTS[v - 1]}'{gone}"


def _logged(spark, d):
    orders, path = read_table(spark, d, "orders"), _fresh(spark, "order-changes")
    before = orders.limit(0).select(*_ORDER)
    for v in (1, 2, 3):
        CH.append_changes(CH.changes_between(before, _version(orders, v), "o_orderkey", v), path)
        before = CH.state_at(spark, path, "o_orderkey")  # what the log holds, not the snapshot
    return path


def change_log_state(spark, d):
    """The orders as of the last version, from the log alone."""
    return CH.state_at(spark, _logged(spark, d), "o_orderkey")


register("change_log_state", _version_sql(3))(change_log_state)


def change_log_feed(spark, d):
    """The feed from version 2 on."""
    return CH.read_changes(spark, _logged(spark, d), 2)


_step = """SELECT coalesce(n.o_orderkey, o.o_orderkey) AS o_orderkey,
       CASE WHEN n.o_orderkey IS NULL THEN o.o_orderstatus ELSE n.o_orderstatus END AS o_orderstatus,
       CASE WHEN n.o_orderkey IS NULL THEN o.o_totalprice ELSE n.o_totalprice END AS o_totalprice,
       CASE WHEN o.o_orderkey IS NULL THEN 'insert' WHEN n.o_orderkey IS NULL THEN 'delete' ELSE 'update' END AS change_type, {v}::BIGINT AS version
  FROM v{u} o FULL JOIN v{v} n ON o.o_orderkey = n.o_orderkey
  WHERE o.o_orderkey IS NULL OR n.o_orderkey IS NULL OR o.o_orderstatus IS DISTINCT FROM n.o_orderstatus OR o.o_totalprice IS DISTINCT FROM n.o_totalprice"""
register("change_log_feed", f"""WITH {", ".join(f"v{v} AS ({_version_sql(v)})" for v in (1, 2, 3))}
{_step.format(u=1, v=2)} UNION ALL {_step.format(u=2, v=3)}""")(change_log_feed)


# ---------------------------------------------------------------- schema log

def schema_generations(spark, d):
    """Two generations of event properties: the second has one more field, which the stored schema doesn't."""
    e = read_table(spark, d, "events").select("event_id", "props")
    path = _fresh(spark, "schema-log")
    old = e.where("event_id % 2 = 0")
    extra = F.concat(F.lit('{"tag": "t'), (F.col("event_id") % 7).cast("string"), F.lit('", '), F.substring("props", 2, 2 ** 31 - 1))
    new = e.where("event_id % 2 = 1").withColumn("props", extra)
    first = read_kept(old, "props", "events", path)
    second = read_kept(new, "props", "events", path)
    return first.unionByName(second).select("event_id", "k", F.try_element_at(RESCUED, F.lit("tag")).alias("rescued_tag"))


register("schema_generations", """
SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k,
       CASE WHEN event_id % 2 = 1 THEN 't' || (event_id % 7) END AS rescued_tag FROM events
""")(schema_generations)


def schema_admitted(spark, d):
    """The same after the new field was taken into the next version of the schema."""
    e = read_table(spark, d, "events").select("event_id", "props")
    path = _fresh(spark, "schema-log")
    extra = F.concat(F.lit('{"weight": '), (F.col("event_id") % 7 + 0.5).cast("string"), F.lit(", "), F.substring("props", 2, 2 ** 31 - 1))
    admit(e, "props", "events", path)
    new = e.withColumn("props", F.when(F.col("event_id") % 3 == 0, extra).otherwise(F.col("props")))
    admit(new, "props", "events", path)
    return read_kept(new, "props", "events", path).select("event_id", "k", "weight", F.col(RESCUED).isNull().alias("nothing_rescued"))


register("schema_admitted", """
SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, CASE WHEN event_id % 3 = 0 THEN event_id % 7 + 0.5::DOUBLE END AS weight,
       true AS nothing_rescued FROM events
""")(schema_admitted)


# ---------------------------------------------------------------- training by epochs (M3)

SEED, WIDTH, CLASSES = 42, 64, [str(i) for i in range(10)]
SETTINGS = EP.Settings(epochs=3, decay=0.01, rate=1.0)


def _split_rows(spark, d):
    e = read_table(spark, d, "embeddings")
    return e.withColumn("split", split_label(unit_hash(SEED, "vec_id")))


def _trained(spark, d):
    rows, path = _split_rows(spark, d), _fresh(spark, "epochs")
    return rows, path, EP.run_epochs(rows, "label", "embedding", CLASSES, WIDTH, path, SETTINGS)


def train_epochs(spark, d):
    """Losses by epoch and the epoch that is kept."""
    _, _, history = _trained(spark, d)
    return history.select("epoch", round6("train_loss").alias("train_loss"), round6("eval_loss").alias("eval_loss"), "chosen")


_EPOCHS_SQL = f"""
rows AS (SELECT vec_id, label, list_append(list_transform(embedding, lambda v: v::DOUBLE), 1.0::DOUBLE) AS x, {split_case(uhash(SEED, 'vec_id'))} AS split
         FROM embeddings WHERE label BETWEEN 0 AND 9),
cells AS (SELECT c, j FROM range(10) t(c), range(1, {WIDTH + 2}) u(j)),
epochs AS (
  SELECT 0 AS epoch, list_transform(range(10), lambda c: list_transform(range({WIDTH + 1}), lambda j: 0.0::DOUBLE)) AS w
  UNION ALL
  SELECT epoch + 1, (
    SELECT list(wc ORDER BY c) FROM (
      SELECT c, list(e.w[c + 1][j] - {SETTINGS.rate}::DOUBLE * (g / n + CASE WHEN j <= {WIDTH} THEN {SETTINGS.decay}::DOUBLE * e.w[c + 1][j] ELSE 0.0::DOUBLE END) ORDER BY j) AS wc
      FROM (
        SELECT c, j, sum((p[c + 1] - CASE WHEN label = c THEN 1 ELSE 0 END) * x[j]) AS g, count(*) AS n
        FROM (SELECT label, x, list_transform(z, lambda v: exp(v - list_max(z)) / list_sum(list_transform(z, lambda u: exp(u - list_max(z))))) AS p
              FROM (SELECT label, x, list_transform(e.w, lambda v: list_inner_product(v, x)) AS z FROM rows WHERE split = 'train')), cells
        GROUP BY c, j)
      GROUP BY c))
  FROM epochs e WHERE epoch < {SETTINGS.epochs}),
losses AS (
  SELECT epoch, avg(l) FILTER (WHERE split = 'train') AS train_loss, avg(l) FILTER (WHERE split = 'validation') AS eval_loss
  FROM (SELECT epoch, split, ln(list_sum(list_transform(z, lambda u: exp(u - list_max(z))))) + list_max(z) - z[label + 1] AS l
        FROM (SELECT epoch, split, label, list_transform(w, lambda v: list_inner_product(v, x)) AS z FROM epochs, rows WHERE split <> 'test'))
  GROUP BY epoch),
chosen AS (SELECT *, row_number() OVER (ORDER BY eval_loss, epoch) = 1 AS chosen FROM losses)"""
register("train_epochs", f"""WITH RECURSIVE {_EPOCHS_SQL}
SELECT epoch, {r6('train_loss')} AS train_loss, {r6('eval_loss')} AS eval_loss, chosen FROM chosen""")(train_epochs)


# ---------------------------------------------------------------- batch inference (M1, I4)

# Fixed weights of a linear model over normalised components, by a rule.
MEAN, STD = 0.485, 0.229  # fixed values of the surveyed normalisation (first channel)


def fixed_weights():
    c, j = np.meshgrid(np.arange(10), np.arange(WIDTH + 1), indexing="ij")
    return ((c * 31 + j * 17) % 13 - 6) / 10.0, CLASSES


def batch_inference(spark, d):
    """Class and probability of every vector under the fixed weights."""
    model = IN.classifier(fixed_weights, WIDTH, MEAN, STD)
    scored = IN.score(read_table(spark, d, "embeddings"), "embedding", model, CLASSES, WIDTH)
    return scored.select("vec_id", "pred_label", round6("pred_score").alias("pred_score"))


register("batch_inference", f"""
WITH w AS (SELECT list(r ORDER BY c) AS w FROM (SELECT c, list(((c * 31 + j * 17) % 13 - 6) / 10.0::DOUBLE ORDER BY j) AS r
           FROM range(10) t(c), range({WIDTH + 1}) u(j) GROUP BY c)),
z AS (SELECT vec_id, list_transform(w.w, lambda r: list_inner_product(r, list_append(list_transform(embedding, lambda v: (v::DOUBLE - {MEAN}::DOUBLE) / {STD}::DOUBLE), 1.0::DOUBLE))) AS z
      FROM embeddings, w WHERE len(embedding) = {WIDTH}),
p AS (SELECT vec_id, list_transform(z, lambda v: exp(v - list_max(z)) / list_sum(list_transform(z, lambda u: exp(u - list_max(z))))) AS p FROM z)
SELECT vec_id, CAST(list_position(p, list_max(p)) - 1 AS VARCHAR) AS pred_label, {r6('list_max(p)')} AS pred_score FROM p
""")(batch_inference)


def best_epoch_scores(spark, d):
    """The test rows under the weights of the epoch that was kept."""
    rows, path, history = _trained(spark, d)
    weights = EP.best_weights(spark, path, history, CLASSES)
    model = IN.classifier(lambda: (weights if weights.size else np.zeros((10, WIDTH + 1)), CLASSES), WIDTH)
    scored = IN.score(rows.where("split = 'test'"), "embedding", model, CLASSES, WIDTH)
    return scored.select("vec_id", F.col("label").cast("string").alias("truth"), "pred_label", round6("pred_score").alias("pred_score"))


register("best_epoch_scores", f"""WITH RECURSIVE {_EPOCHS_SQL},
z AS (SELECT vec_id, label, list_transform(w, lambda v: list_inner_product(v, x)) AS z
      FROM rows, epochs JOIN chosen USING (epoch) WHERE chosen AND split = 'test'),
p AS (SELECT vec_id, label, list_transform(z, lambda v: exp(v - list_max(z)) / list_sum(list_transform(z, lambda u: exp(u - list_max(z))))) AS p FROM z)
SELECT vec_id, CAST(label AS VARCHAR) AS truth, CAST(list_position(p, list_max(p)) - 1 AS VARCHAR) AS pred_label, {r6('list_max(p)')} AS pred_score FROM p
""")(best_epoch_scores)
