"""Data-quality rules (Q1-Q3, A15) and dataset flags (Q4-Q6).

A rule is (name, SQL boolean, action). ``drop`` rules filter rows out,
``warn`` rules only count. A rule whose expression is NULL counts as failed.
The per-rule report is one aggregation (partial per task, one row per rule
after a tiny unpivot), so it costs a single pass whatever the row count.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass
class Rules:
    drop: dict[str, str] = field(default_factory=dict)
    warn: dict[str, str] = field(default_factory=dict)

    def items(self):
        for n, e in self.drop.items():
            yield n, e, "drop"
        for n, e in self.warn.items():
            yield n, e, "warn"


def passes(expr: str) -> Column:
    return F.coalesce(F.expr(expr), F.lit(False))


def kept(df: DataFrame, rules: Rules) -> DataFrame:
    """Q1: rows that pass every drop rule (warn rules leave rows alone)."""
    cond = F.lit(True)
    for _, e in rules.drop.items():
        cond = cond & passes(e)
    return df.filter(cond)


def report(df: DataFrame, rules: Rules) -> DataFrame:
    """(rule, action, checked, failed) with one aggregation pass."""
    aggs = [F.count(F.lit(1)).alias("_checked")]
    names = []
    for i, (n, e, a) in enumerate(rules.items()):
        aggs.append(F.count_if(~passes(e)).alias(f"_f{i}"))
        names.append((n, a))
    wide = df.agg(*aggs)
    stack = ", ".join(f"'{n}', '{a}', _f{i}" for i, (n, a) in enumerate(names))
    return wide.selectExpr(f"stack({len(names)}, {stack}) AS (rule, action, failed)",
                           "_checked AS checked").select(
        "rule", "action", F.col("checked").cast("bigint"), F.col("failed").cast("bigint"))


def apply_rules(df: DataFrame, rules: Rules) -> tuple[DataFrame, DataFrame]:
    return kept(df, rules), report(df, rules)


def apply_rules_observed(df: DataFrame, rules: Rules, name: str = "dq"):
    """Q1-Q3 in the same pass as the write: returns (kept rows, observation).

    The counts are gathered by ``DataFrame.observe`` while the kept rows are
    produced by whatever action consumes them (a table write), so the input
    -- e.g. the image job -- runs once. After that action,
    ``observed_report(spark, observation, rules)`` gives the report rows."""
    from pyspark.sql import Observation
    obs = Observation(name)
    return kept(df.observe(obs, *rule_counts(rules)), rules), obs


def rule_counts(rules: Rules) -> list[Column]:
    """The counters that an observation gathers: rows seen and failures of each rule."""
    failed = [F.count_if(~passes(e)).alias(f"_f{i}") for i, (_, e, _) in enumerate(rules.items())]
    return [F.count(F.lit(1)).alias("_checked"), *failed]


def observed_report(spark, obs, rules: Rules) -> DataFrame:
    """The (rule, action, checked, failed) rows of an ``apply_rules_observed``
    observation (one row per rule, built from a dict of counters)."""
    m = obs.get
    rows = [(n, a, int(m["_checked"]), int(m[f"_f{i}"])) for i, (n, e, a) in enumerate(rules.items())]
    return spark.createDataFrame(rows, "rule string, action string, checked bigint, failed bigint")


# Q4/Q6 fixed values of the surveyed diagnostics: (flag, expression over the
# class-size summary columns total, min_n, max_n, ratio, accuracy).
DATASET_FLAGS = [
    ("significant_imbalance", "ratio > 3"),
    ("very_small_class", "min_n < 50"),
    ("small_total", "total < 500"),
    ("extreme_imbalance", "max_n > 5 * min_n"),
]

RECOMMENDATIONS = [
    # (priority, rule, condition, action text)
    (1, "collect_more_data", "total < 1000", "collect more data: target 1000+ samples"),
    (1, "balance_dataset", "min_n < 100", "balance dataset: target 100+ per class"),
    (2, "improve_training", "accuracy < 0.6", "improve training: more epochs, augmentation"),
    (3, "address_imbalance", "ratio > 3", "address class imbalance: class weights, stratified sampling"),
]

# Q6 fixed values of the outlook: (section, item, condition, text if it holds, text otherwise; null: no row).
OUTLOOK = [
    ("improvement", "more data (2-3x)", "total < 500", "+15-25% accuracy", None),
    ("improvement", "10 epochs", "epochs = 3", "+5-15% accuracy", None),
    ("improvement", "balanced classes", "min_n < 50", "+10-20% accuracy", None),
    ("target", "short term", "total < 500", "50-60% accuracy", "65-75% accuracy"),
    ("target", "long term", "total < 500", "75-85% accuracy", "80-90% accuracy"),
]


def band(x: Column, edges: list[tuple[float, str]], otherwise: str) -> Column:
    """Q5/M5: first label whose upper edge ``x`` is below, else ``otherwise``."""
    out = None
    for edge, label in edges:
        out = (F.when(x < F.lit(edge), F.lit(label)) if out is None
               else out.when(x < F.lit(edge), F.lit(label)))
    return out.otherwise(F.lit(otherwise)) if out is not None else F.lit(otherwise)


# Q5 fixed values: accuracy bands and loss notes.
ACCURACY_BANDS = [(0.3, "critical"), (0.5, "poor"), (0.7, "fair"), (0.85, "good")]
ACCURACY_TOP = "excellent"


def accuracy_band(acc: Column) -> Column:
    return band(acc, ACCURACY_BANDS, ACCURACY_TOP)


def loss_note(loss: Column) -> Column:
    return (F.when(loss > F.lit(2.0), F.lit("high"))
            .when(loss < F.lit(0.1), F.lit("very_low"))
            .otherwise(F.lit("normal")))
