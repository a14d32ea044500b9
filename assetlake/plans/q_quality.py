"""Data-quality rules and class-balance diagnostics."""

from __future__ import annotations

from pyspark.sql import functions as F

from assetlake.functions.columns import round6
from assetlake.operators import diagnose as D
from assetlake.operators.quality import DATASET_FLAGS, OUTLOOK, RECOMMENDATIONS, Rules, apply_rules
from assetlake.plans.registry import r6, register
from assetlake.sources.tables import read_table

# Rules over line items, written once and used by Spark and the oracle.
LINE_RULES = Rules(
    drop={
        "positive_quantity": "l_quantity > 0",
        "discount_range": "l_discount BETWEEN 0.0 AND 0.08",
        "known_flag": "l_returnflag IN ('A', 'N')",
        "tax_cap": "l_tax <= 0.06",
    },
    warn={"high_price": "l_extendedprice < 50000"},
)


def _lines(spark, d):
    return read_table(spark, d, "lineitem").select(
        "l_quantity", "l_discount", "l_returnflag", "l_linestatus", "l_tax", "l_extendedprice")


def dq_drop(spark, d):
    kept, _ = apply_rules(_lines(spark, d), LINE_RULES)
    return kept.groupBy("l_returnflag", "l_linestatus").agg(
        F.count(F.lit(1)).cast("bigint").alias("kept"),
        F.sum("l_quantity").alias("sum_qty"))


_drop_all = " AND ".join(f"coalesce(({e}), false)" for e in LINE_RULES.drop.values())
register("dq_drop", f"""
SELECT l_returnflag, l_linestatus, CAST(count(*) AS BIGINT) AS kept, sum(l_quantity) AS sum_qty
FROM lineitem WHERE {_drop_all} GROUP BY l_returnflag, l_linestatus
""")(dq_drop)


def dq_report(spark, d):
    _, rep = apply_rules(_lines(spark, d), LINE_RULES)
    return rep


register("dq_report", " UNION ALL ".join(
    f"SELECT '{n}' AS rule, '{a}' AS action, CAST(count(*) AS BIGINT) AS checked, "
    f"CAST(count(*) FILTER (WHERE NOT coalesce(({e}), false)) AS BIGINT) AS failed FROM lineitem"
    for n, e, a in LINE_RULES.items()))(dq_report)


# ---------------------------------------------------------------- class balance (documents by lang)

def _dist(spark, d):
    return D.distribution(read_table(spark, d, "documents").select("lang"), "lang")


def class_distribution(spark, d):
    return _dist(spark, d)


_DIST_SQL = """c AS (SELECT lang AS class, CAST(count(*) AS BIGINT) AS n FROM documents GROUP BY lang)"""

register("class_distribution", f"""WITH {_DIST_SQL}
SELECT class, n, floor(n * 100.0::DOUBLE / sum(n) OVER () * 10.0::DOUBLE + 0.5::DOUBLE) / 10.0::DOUBLE AS pct FROM c
""")(class_distribution)


def imbalance(spark, d):
    s = D.summary(_dist(spark, d))
    return s.select("total", "classes", "min_n", "max_n", "smallest_class",
                    round6("ratio").alias("ratio"), round6("mean_per_class").alias("mean_per_class"))


_SUMMARY_SQL = f"""{_DIST_SQL},
s AS (SELECT CAST(sum(n) AS BIGINT) AS total, CAST(count(*) AS BIGINT) AS classes,
             CAST(min(n) AS BIGINT) AS min_n, CAST(max(n) AS BIGINT) AS max_n,
             (SELECT class FROM c ORDER BY n, class LIMIT 1) AS smallest_class FROM c)"""

register("imbalance", f"""WITH {_SUMMARY_SQL}
SELECT total, classes, min_n, max_n, smallest_class,
       {r6('max_n::DOUBLE / min_n')} AS ratio, {r6('total::DOUBLE / classes')} AS mean_per_class FROM s
""")(imbalance)


def imbalance_flags(spark, d):
    return D.flags(D.summary(_dist(spark, d)))


register("imbalance_flags", f"""WITH {_SUMMARY_SQL},
t AS (SELECT *, max_n::DOUBLE / min_n AS ratio FROM s)
""" + " UNION ALL ".join(f"SELECT '{n}' AS flag, ({e}) AS hit FROM t" for n, e in DATASET_FLAGS)
)(imbalance_flags)


def recommendations(spark, d):
    return D.recommendations(D.summary(_dist(spark, d)))


register("recommendations", f"""WITH {_SUMMARY_SQL},
t AS (SELECT *, max_n::DOUBLE / min_n AS ratio, CAST(0 AS DOUBLE) AS accuracy FROM s)
""" + " UNION ALL ".join(
    f"SELECT {p} AS priority, '{r}' AS rule, coalesce(({c}), false) AS hit, '{txt}' AS action, "
    f"CAST({'CASE WHEN total < 1000 THEN 1000 - total END' if r == 'collect_more_data' else 'NULL'} AS BIGINT) AS need_more FROM t"
    for p, r, c, txt in RECOMMENDATIONS))(recommendations)


# ---------------------------------------------------------------- outlook, by language and by rare label classes

def improvement_outlook(spark, d):
    by_lang = D.outlook(D.summary(_dist(spark, d))).withColumn("of", F.lit("lang"))
    regions = D.distribution(read_table(spark, d, "supplier").select("s_nationkey"), "s_nationkey")
    return by_lang.unionByName(D.outlook(D.summary(regions), epochs=10).withColumn("of", F.lit("nation")))


def _outlook_sql(of: str, source: str, col: str, epochs: int) -> str:
    rows = " UNION ALL ".join(
        f"SELECT '{sec}' AS section, '{item}' AS item, CASE WHEN {cond} THEN '{yes}' ELSE {'NULL' if no is None else repr(no)} END AS outlook FROM t"
        for sec, item, cond, yes, no in OUTLOOK)
    return f"""SELECT section, item, outlook, '{of}' AS of FROM (
WITH c AS (SELECT count(*) AS n FROM {source} GROUP BY {col}),
t AS (SELECT sum(n) AS total, min(n) AS min_n, {epochs} AS epochs FROM c)
{rows}) o WHERE outlook IS NOT NULL"""


register("improvement_outlook", " UNION ALL ".join(
    [_outlook_sql("lang", "documents", "lang", 3), _outlook_sql("nation", "supplier", "s_nationkey", 10)]))(improvement_outlook)
