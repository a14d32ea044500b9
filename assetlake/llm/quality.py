"""Quality rules with risk-controlled cutoffs, in DataFrame functions only.

Each rule compares one figure of a document with a cutoff. The cutoffs are chosen per stratum from
labelled documents so that, with probability 1 - ``delta`` over all strata, rules and cutoffs
together, at most ``alpha`` of a stratum's good documents are rejected:

* labelled documents are split by crc32 of their id into a design half and a holdout half;
* for each stratum, rule and grid cutoff the holdout gives n good documents, k of them rejected;
* a cutoff is certified if P(Bin(n, alpha / rules) <= k) <= delta / tests, the exact one-sided
  binomial test with Bonferroni's correction over every test made (strata x rules x cutoffs);
* of the certified cutoffs the strictest is used whose rejections on the design half are bad
  documents at least ``precision`` of the time. A stratum without one keeps its documents.

The binomial sum runs down from k over at most ``TERMS`` terms; what is left is bounded by a
geometric series and added, so a longer sum can only be judged more strictly.

Defined results: a null text has no words and fails the base rule; a null language is a stratum of
its own; a label joins every row of its id, and where labels disagree the worse one counts;
repeated rows stay; an empty table gives an empty table and no labels give no cutoffs.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from assetlake.llm.common import SPACES, WORD, stage, text_or_empty

GRAM = 5
SYMBOLS = "#*$%&|<>"
#: rule -> (figure, grid of cutoffs from lenient to strict); a document is rejected above the cutoff.
RULES: dict[str, tuple[str, tuple[float, ...]]] = {
    "symbols": ("n_symbols / greatest(n_words, 1)", (2.0, 1.0, 0.5, 0.2, 0.1)),
    "dup_lines": ("n_dup_lines / greatest(n_lines, 1)", (0.8, 0.6, 0.5, 0.4, 0.3, 0.2, 0.1)),
    "repeats": ("n_repeat_words / greatest(n_words, 1)", (0.18, 0.15, 0.12, 0.1, 0.08, 0.06)),
    "few_words": ("1.0 / greatest(n_words, 1)", (1 / 12, 1 / 16, 1 / 20, 1 / 30, 1 / 40)),
    "shouting": ("n_upper / greatest(word_chars, 1)", (0.9, 0.7, 0.5, 0.3, 0.2)),
}
ALPHA, DELTA, PRECISION = 0.05, 0.05, 0.9
TERMS = 4096


def figures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", stratum: str = "lang") -> DataFrame:
    """The base figures of every document. Arrays live within one row, so nothing is shuffled."""
    text = text_or_empty(text_col)
    d = docs.select(F.col(id_col).alias("doc_id"), F.col(stratum).cast("string").alias("stratum"), text.alias("t"))
    words = F.array_remove(F.split("t", SPACES), "")
    lines = F.filter(F.split("t", "\n"), lambda x: x.rlike(WORD))
    d = d.select(
        "doc_id", "stratum", words.alias("w"), lines.alias("l"),
        F.length(F.regexp_replace("t", SPACES, "")).cast("long").alias("word_chars"),
        (F.length("t") - F.length(F.regexp_replace("t", "[#*$%&|<>]", ""))).cast("long").alias("n_symbols"),
        (F.length("t") - F.length(F.regexp_replace("t", r"\p{Lu}", ""))).cast("long").alias("n_upper"))
    w = F.col("w")
    grams = F.when(F.size("w") >= GRAM, F.transform(
        F.sequence(F.lit(0), F.size("w") - GRAM), lambda i: F.xxhash64(*[F.get(w, i + j) for j in range(GRAM)]))
    ).otherwise(F.array().cast("array<bigint>"))
    d = d.select(
        "doc_id", "stratum", "word_chars", "n_symbols", "n_upper", F.size("w").cast("long").alias("n_words"),
        F.size("l").cast("long").alias("n_lines"), (F.size("l") - F.size(F.array_distinct("l"))).cast("long").alias("n_dup_lines"),
        grams.alias("g"))
    # only a text with an equal pair of windows is sorted: equal windows then stand side by side
    pairs = F.when(F.size(F.array_distinct("g")) < F.size("g"), F.array_sort(
        F.transform("g", lambda x, i: F.struct(x.alias("h"), i.alias("p")))))
    d = d.drop("l").withColumn("s", pairs).drop("g")
    s = F.col("s")
    twice = F.transform(s, lambda e, j: F.when(
        (F.get(s, j - 1)["h"] == e["h"]) | (F.get(s, j + 1)["h"] == e["h"]), e["p"]))
    d = d.withColumn("p", F.sort_array(F.filter(twice, lambda x: x.isNotNull()))).drop("s")
    covered = F.aggregate(
        "p", F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("end")),
        lambda a, x: F.struct((a["n"] + x + GRAM - F.greatest(a["end"], x.cast("long"))).alias("n"), (x + GRAM).cast("long").alias("end")),
        lambda a: a["n"])
    d = d.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long")).drop("p")
    return d.withColumn("base_failed", (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words")))


def _log_gamma(x: Column) -> Column:
    """ln Gamma(x) for x >= 1 by Stirling's series at x + 10 (error below 1e-13)."""
    y = x + 10
    series = (y - 0.5) * F.log(y) - y + 0.5 * math.log(2 * math.pi) + 1 / (12 * y) - 1 / (360 * y * y * y) + 1 / (1260 * F.pow(y, 5))
    for i in range(10):
        series = series - F.log(x + i)
    return series


def binomial_tail(n: Column, k: Column, p: float) -> Column:
    """P(Bin(n, p) <= k), never below the true value; 1 where k >= n p (such a k certifies nothing)."""
    n, k = n.cast("double"), k.cast("double")
    top = _log_gamma(n + 1) - _log_gamma(k + 1) - _log_gamma(n - k + 1) + k * math.log(p) + (n - k) * math.log1p(-p)
    odds = (1 - p) / p

    def step(a, i):
        j = k - i  # from the term of j to that of j - 1
        term = a["term"] * j * odds / (n - j + 1)
        return F.struct(term.alias("term"), (a["sum"] + term).alias("sum"))

    start = F.struct(F.lit(1.0).alias("term"), F.lit(1.0).alias("sum"))
    steps = F.sequence(F.lit(0), F.least(k.cast("long") - 1, F.lit(TERMS)).cast("int"))
    summed = F.when(k >= 1, F.aggregate(steps, start, step)).otherwise(start)
    left = F.greatest(k - TERMS - 1, F.lit(0.0))
    ratio = left * odds / (n - left + 1)
    total = summed["sum"] + F.when(left > 0, summed["term"] * ratio / (1 - ratio)).otherwise(0.0)
    return F.when((n > 0) & (k < n * p), F.exp(top + F.log(total) + 1e-9)).otherwise(F.lit(1.0))


def cutoffs(figs: DataFrame, labels: DataFrame, alpha: float = ALPHA, delta: float = DELTA, precision: float = PRECISION) -> DataFrame:
    """(stratum, rule, cutoff): the certified cutoffs. At most strata x rules rows."""
    truth = (labels.select("doc_id", "quality").where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
             .groupBy("doc_id").agg(F.min("quality").alias("good")))
    known = figs.where(~F.col("base_failed")).join(truth, "doc_id")
    level = [F.struct(F.lit(r).alias("rule"), sum((F.expr(x) > c).cast("int") for c in grid).alias("level")) for r, (x, grid) in RULES.items()]
    holdout = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    # a row per rule before the shuffle is summed map-side: at most strata x rules x levels groups
    counts = (known.select("stratum", "good", holdout.alias("holdout"), F.explode(F.array(*level)).alias("x"))
              .groupBy("stratum", "x.rule", "x.level")
              .agg(F.sum((F.col("holdout") & (F.col("good") == 1)).cast("long")).alias("good_held"),
                   F.sum((~F.col("holdout") & (F.col("good") == 1)).cast("long")).alias("good_design"),
                   F.sum((~F.col("holdout") & (F.col("good") != 1)).cast("long")).alias("bad_design")))
    counts = stage(counts, "quality-counts")
    grid = counts.sparkSession.createDataFrame(
        [(r, i + 1, float(c)) for r, (_, g) in RULES.items() for i, c in enumerate(g)], "rule string, level int, cutoff double")
    # every cutoff is a test, also one that no document exceeds
    tests = counts.groupBy("stratum", "rule").agg(F.sum("good_held").alias("n")).join(grid, "rule")
    made = counts.select("stratum").distinct().count() * sum(len(g) for _, g in RULES.values())
    above = (tests.alias("t").join(counts.alias("c"), F.col("t.stratum").eqNullSafe(F.col("c.stratum")) & (F.col("t.rule") == F.col("c.rule")) & (F.col("c.level") >= F.col("t.level")), "left")
             .groupBy("t.stratum", "t.rule", "t.level", "t.cutoff", "t.n")
             .agg(*[F.coalesce(F.sum(f"c.{x}"), F.lit(0)).alias(x) for x in ("good_held", "good_design", "bad_design")]))
    tail = binomial_tail(F.col("n"), F.col("good_held"), alpha / len(RULES))
    useful = (F.col("bad_design") > 0) & (F.col("bad_design") >= precision * (F.col("bad_design") + F.col("good_design")))
    return (above.where((tail <= delta / max(1, made)) & useful)
            .groupBy("stratum", "rule").agg(F.min("cutoff").alias("cutoff")))


def judge(docs: DataFrame, labels: DataFrame, alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """Figures and verdict of every document; ``failed_rules`` names the certified rules it fails."""
    figs = stage(figures(docs), "quality-figures")
    chosen = cutoffs(figs, labels, alpha, delta).groupBy("stratum").pivot("rule", list(RULES)).agg(F.first("cutoff"))
    chosen = chosen.select(F.col("stratum").alias("at"), *[F.col(r).alias(f"cut_{r}") for r in RULES])
    judged = figs.join(chosen, figs.stratum.eqNullSafe(chosen["at"]), "left")
    failed = F.filter(F.array(*[F.when(F.expr(x) > F.col(f"cut_{r}"), F.lit(r)) for r, (x, _) in RULES.items()]), lambda x: x.isNotNull())
    return judged.withColumn("failed_rules", failed).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & (F.size("failed_rules") == 0)).alias("kept"), F.concat_ws(",", "failed_rules").alias("failed_rules"))
