"""Incremental-ingest queries over the events table seen as a labelled stream
(key = event_type, idx = event_id)."""

from __future__ import annotations

from pyspark.sql import functions as F

from assetlake.functions.columns import asset_filename
from assetlake.operators import ingest as I
from assetlake.plans.registry import register
from assetlake.sources.tables import read_table

# Stored status before this run (the ingest_status table): a known key, a
# legacy row without index (its count restarts), a key with nothing new and
# a key nobody asks for (left untouched).
STATUS = [
    ("view", 100, 1000, "view_idx_001000.jpg"),
    ("click", 7, None, None),
    ("signup", 3, 10**12, "signup_idx_1000000000000.jpg"),
    ("refund", 4, 50, "refund_idx_000050.jpg"),
]
WANTED = ["click", "purchase", "view", "signup", "unknown_type"]
PER_KEY = 5

_status_sql = ", ".join(
    "({}, {}, {}, {})".format(
        f"'{k}'", c, "CAST(NULL AS BIGINT)" if li is None else f"CAST({li} AS BIGINT)",
        "CAST(NULL AS VARCHAR)" if fn is None else f"'{fn}'")
    for k, c, li, fn in STATUS)
_wanted_sql = ", ".join(f"('{k}')" for k in WANTED)

_PICKED_SQL = f"""
status(key, cnt, last_index, last_filename) AS (VALUES {_status_sql}),
wanted(key) AS (VALUES {_wanted_sql}),
ex AS (SELECT event_type AS key, event_id AS idx FROM events WHERE event_type IN (SELECT key FROM wanted)),
f AS (SELECT ex.* FROM ex LEFT JOIN status s ON ex.key = s.key WHERE ex.idx > coalesce(s.last_index, -1)),
r AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY idx) AS rank FROM f),
picked AS (SELECT key, idx, rank, printf('%s_idx_%06d.jpg', key, idx) AS filename FROM r WHERE rank <= {PER_KEY})"""


def _inputs(spark, d):
    ev = read_table(spark, d, "events").select("event_type", "event_id")
    status = I.status_frame(spark, STATUS)
    wanted = spark.createDataFrame([(k,) for k in WANTED], "key string")
    return ev, status, wanted


def _picked(spark, d):
    ev, status, wanted = _inputs(spark, d)
    return I.plan(ev, status, wanted, PER_KEY, key="event_type", idx="event_id"), ev, status, wanted


def ingest_plan(spark, d):
    p, *_ = _picked(spark, d)
    return p.select(F.col("event_type").alias("key"), F.col("event_id").alias("idx"), "rank", "filename")


register("ingest_plan", f"""WITH {_PICKED_SQL}
SELECT key, idx, CAST(rank AS INTEGER) AS rank, filename FROM picked
""")(ingest_plan)


def ingest_status_merge(spark, d):
    p, _, status, _ = _picked(spark, d)
    return I.merge_status(status, p, key="event_type", idx="event_id")


register("ingest_status_merge", f"""WITH {_PICKED_SQL},
agg AS (SELECT key, count(*) AS n_new, max(idx) AS last_idx, arg_max(filename, idx) AS last_file
        FROM picked GROUP BY key),
o AS (SELECT key, CASE WHEN last_index IS NULL THEN 0 ELSE cnt END AS old_cnt, last_index, last_filename FROM status)
SELECT coalesce(o.key, a.key) AS key,
       CAST(coalesce(o.old_cnt, 0) + coalesce(a.n_new, 0) AS BIGINT) AS count,
       CAST(coalesce(a.last_idx, o.last_index) AS BIGINT) AS last_index,
       coalesce(a.last_file, o.last_filename) AS last_filename
FROM o FULL OUTER JOIN agg a ON o.key = a.key
""")(ingest_status_merge)


def ingest_report(spark, d):
    p, ev, _, wanted = _picked(spark, d)
    valid, _missing = I.wanted_split(wanted, ev.select(F.col("event_type").alias("key")))
    return I.run_report(p, valid, PER_KEY, key="event_type")


register("ingest_report", f"""WITH {_PICKED_SQL},
valid AS (SELECT DISTINCT key FROM wanted WHERE key IN (SELECT event_type FROM events)),
per AS (SELECT key, count(*) AS new FROM picked GROUP BY key),
rep AS (SELECT v.key, CAST(coalesce(p.new, 0) AS BIGINT) AS new FROM valid v LEFT JOIN per p ON v.key = p.key)
SELECT key, new, new >= {PER_KEY} AS complete,
       CAST(sum(new) OVER () AS BIGINT) AS total_saved,
       CAST(count(*) FILTER (WHERE new >= {PER_KEY}) OVER () AS BIGINT) AS completed_keys,
       bool_and(new >= {PER_KEY}) OVER () AS all_complete,
       CAST(row_number() OVER (ORDER BY key) AS INTEGER) AS listing_rank,
       row_number() OVER (ORDER BY key) <= 20 AS shown,
       CAST(greatest(count(*) OVER () - 20, 0) AS BIGINT) AS hidden_keys
FROM rep
""")(ingest_report)


def ingest_missing_keys(spark, d):
    ev, _, wanted = _inputs(spark, d)
    _, missing = I.wanted_split(wanted, ev.select(F.col("event_type").alias("key")))
    return missing


register("ingest_missing_keys", f"""
WITH wanted(key) AS (VALUES {_wanted_sql})
SELECT key FROM wanted WHERE key NOT IN (SELECT event_type FROM events WHERE event_type IS NOT NULL)
""")(ingest_missing_keys)


# A stored status with many keys, from the orders: a key is a customer's label, some rows are legacy ones.
LEGACY_EVERY = 7


def _stored_status(spark, d):
    o = read_table(spark, d, "orders").where(F.col("o_custkey").isNotNull())
    per = o.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("count"), F.max("o_orderkey").alias("last"))
    key = F.format_string("customer_%d", F.col("o_custkey"))
    legacy = F.col("o_custkey") % LEGACY_EVERY == 0
    return per.select(key.alias("key"), "count", F.when(~legacy, F.col("last")).alias("last_index"), asset_filename(key, F.col("last")).alias("last_filename"))


def ingest_listing(spark, d):
    listed = I.status_listing(_stored_status(spark, d))
    return listed.withColumn("last_index", F.coalesce("last_index", F.lit(-1)))  # where a legacy row starts again


register("ingest_listing", f"""
WITH s AS (SELECT printf('customer_%d', o_custkey) AS key, count(*) AS n, max(o_orderkey) AS last, o_custkey % {LEGACY_EVERY} = 0 AS legacy
           FROM orders WHERE o_custkey IS NOT NULL GROUP BY o_custkey)
SELECT key, n AS count, CASE WHEN legacy THEN -1 ELSE last END AS last_index, legacy,
       CASE WHEN legacy THEN printf('%s_idx_%06d.jpg (old format)', key, last)
            ELSE n || ' images | last_index: ' || last END AS line,
       row_number() OVER (ORDER BY key) AS listing_rank, row_number() OVER (ORDER BY key) <= 20 AS shown,
       CAST(greatest(count(*) OVER () - 20, 0) AS BIGINT) AS hidden_keys
FROM s
""")(ingest_listing)
