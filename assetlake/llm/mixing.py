"""Mixing sources to target weights by Sainte-Lague apportionment, in DataFrame functions only.

Sizes are word counts. The sources, in code point order with null last, weigh 5, 2, 1, 5, 2, 1 ...;
their targets share all words by weight, none above ``CAP`` times its source's words: what a capped
source can't use is shared again among the others until none is above.

The target is handed out in blocks of ``BLOCK`` words. Blocks go to sources, and a source's blocks to
its shards (``SHARD_DOCS`` documents each, by seeded hash), by highest quotients target / (2 q + 1)
where q counts the blocks already given. Within a shard the documents stand in seeded order as one
stream of words, cut into equal blocks; a quota of whole streams repeats every document, the rest is
a seeded run of consecutive blocks, wrapping around. A run's documents are random since their order is.

Quotients: at the price P = words per block, a source has round(target / P) blocks; the sum misses the
wanted number by at most half the sources, and the few blocks too many (or few) are those of the
lowest (or highest) quotients near it, so no quotient further away has to be listed.

Defined results: a null text has no words; a null source is a source; documents without words, and
sources without words, take none; repeated rows are apart; reruns agree; an empty table gives an
empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from assetlake.llm.common import SPACES, stage, with_text, word_count

#: Fixed values of the mix.
WEIGHTS = (5.0, 2.0, 1.0)
CAP = 3
BLOCK = 16
SHARD_DOCS = 20_000
SEED = 7


def targets(sources: DataFrame) -> DataFrame:
    """``sources`` (source, source_size) with ``target``: words for each source.

    Sources are few against documents; each round is one aggregate of their table and closes at
    least one source, and all that a round closes are closed at once.
    """
    order = Window.orderBy(F.col("source").isNull(), F.col("source").cast("binary"))
    rank = (F.row_number().over(order) - 1) % len(WEIGHTS)
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), (rank + 1).cast("int"))
    s = stage(sources.withColumn("weight", weight).withColumn("cap", CAP * F.col("source_size").cast("double")), "mix-sources")
    price = None  # words per unit of weight
    closed = F.lit(False)
    while True:
        r = s.select("source_size", "weight", "cap", closed.alias("closed")).agg(
            F.sum(F.col("source_size")).alias("all"), F.sum(F.when(F.col("closed"), F.col("cap")).otherwise(0.0)).alias("shut"),
            F.sum(F.when(F.col("closed"), 0.0).otherwise(F.col("weight"))).alias("open"), F.count_if("closed").alias("n")).first()
        if not r["open"]:
            break
        now = (r["all"] - r["shut"]) / r["open"]
        if price is not None and now <= price:
            break
        price = now
        closed = F.col("cap") <= F.lit(price) * F.col("weight")
    share = F.col("cap") if price is None else F.least(F.col("cap"), F.lit(price) * F.col("weight"))
    return s.select("source", "source_size", share.alias("target"))


def sainte_lague(claims: DataFrame, group: list[str], key: list[str], claim: str, seats: Column, out: str) -> DataFrame:
    """Whole numbers of seats for each key of a group by highest quotients claim / (2 q + 1).

    ``seats`` is a column of the group. Null-safe: groups and keys may be null.
    """
    w = Window.partitionBy(*group) if group else Window.partitionBy(F.lit(1))
    d = claims.withColumn("_all", F.sum(claim).over(w)).withColumn("_seats", seats)
    ideal = F.when(F.col("_all") > 0, F.col(claim) * F.col("_seats") / F.col("_all")).otherwise(0.0)
    d = d.withColumn("_q", F.floor(ideal + 0.5)).withColumn("_off", F.col("_seats") - F.sum("_q").over(w))
    # how many seats a key may gain or lose: its share of what is off, and two for rounding
    near = F.ceil(F.abs(F.col("_off")) * F.col(claim) / F.greatest(F.col("_all"), F.lit(1e-300))) + 2
    steps = F.when((F.col("_off") == 0) | (F.col(claim) <= 0), F.array().cast("array<bigint>")).otherwise(
        F.sequence(F.lit(0).cast("bigint"), near - 1))
    d = d.withColumn("_k", F.explode_outer(steps))
    add = F.col("_off") > 0
    seat = F.when(add, F.col("_q") + F.col("_k")).otherwise(F.col("_q") - 1 - F.col("_k"))
    d = d.withColumn("_seat", seat)
    quotient = F.when(F.col("_seat") >= 0, F.col(claim) / (2 * F.col("_seat") + 1))
    d = d.withColumn("_quotient", quotient)
    # seats are added from the highest quotient and taken from the lowest
    ranked = F.row_number().over((Window.partitionBy(*group) if group else Window.partitionBy(F.lit(1))).orderBy(
        F.col("_quotient").isNull(), F.when(add, -F.col("_quotient")).otherwise(F.col("_quotient")), *key))
    moved = (F.col("_quotient").isNotNull() & (ranked <= F.abs(F.col("_off")))).cast("bigint")
    d = d.withColumn("_moved", moved)
    kept = [c for c in claims.columns]
    return (d.groupBy(*kept, "_q", "_off").agg(F.sum("_moved").alias("_m"))
            .select(*kept, (F.col("_q") + F.signum("_off").cast("bigint") * F.col("_m")).alias(out)))


def _draw(id_col: str, text_col: str) -> Column:
    return F.xxhash64(F.lit(SEED), F.col(id_col), F.col(text_col))


def shares(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """Per document: size, its source's size and target, whole turns, and the runs of words taken besides."""
    sized = stage(docs.select(
        F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"), word_count(F.col(text_col).cast("string")).alias("size"),
        _draw(id_col, text_col).alias("draw")), "mix-sizes")
    per_source = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n"))
    known = stage(targets(per_source.select("source", "source_size")), "mix-targets")
    counts = stage(per_source.select(F.col("source").alias("s"), F.ceil(F.col("n") / SHARD_DOCS).alias("shards")), "mix-counts")
    quotas = sainte_lague(known, [], ["source"], "target", F.floor(F.sum("target").over(Window.partitionBy(F.lit(1))) / BLOCK + 0.5), "blocks")
    quotas = stage(quotas.join(counts, quotas["source"].eqNullSafe(counts["s"])).drop("s"), "mix-quotas").withColumnRenamed("source", "s")
    placed = (sized.join(quotas, sized["source"].eqNullSafe(quotas["s"])).drop("s")
              .withColumn("shard", F.pmod(F.shiftright("draw", 8), F.col("shards"))))
    shards = placed.groupBy("source", "shard").agg(F.sum("size").alias("stream"), F.first("blocks").alias("blocks"))
    shards = shards.select(F.col("source"), F.col("shard"), F.col("stream"), F.col("blocks"), F.col("stream").cast("double").alias("claim"))
    dealt = sainte_lague(shards, ["source"], ["shard"], "claim", F.col("blocks"), "quota")
    words = F.least(F.col("quota") * BLOCK, CAP * F.col("stream"))
    start = F.pmod(F.xxhash64(F.lit(SEED), F.col("source"), F.col("shard")), F.greatest(F.ceil(F.col("stream") / BLOCK), F.lit(1))) * BLOCK
    dealt = dealt.select(F.col("source").alias("s"), F.col("shard").alias("h"), "stream", words.alias("words"), start.alias("run"))
    placed = placed.drop("blocks", "shards").join(
        dealt, placed["source"].eqNullSafe(dealt["s"]) & (placed["shard"] == dealt["h"])).drop("s", "h")
    seeded = Window.partitionBy("source", "shard").orderBy("draw", "doc_id", "size").rowsBetween(Window.unboundedPreceding, 0)
    placed = placed.withColumn("end", F.sum("size").over(seeded)).withColumn("begin", F.col("end") - F.col("size"))
    turns = F.when(F.col("stream") > 0, F.floor(F.col("words") / F.greatest("stream", F.lit(1)))).otherwise(0)
    placed = placed.withColumn("turns", turns).withColumn("rest", F.col("words") - F.col("turns") * F.col("stream"))

    def overlap(a, b):
        return F.greatest(F.least(F.col("end"), b) - F.greatest(F.col("begin"), a), F.lit(0))

    stop = F.col("run") + F.col("rest")
    return placed.select(
        "doc_id", "source", "size", "source_size", "target", "draw", F.col("turns").cast("long").alias("turns"),
        F.greatest(F.col("run") - F.col("begin"), F.lit(0)).cast("long").alias("first"), overlap(F.col("run"), stop).cast("long").alias("inner"),
        overlap(F.lit(0), stop - F.col("stream")).cast("long").alias("wrapped"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """Per document: size, its source's size and target, and the words that the mix takes of it."""
    taken = F.col("turns") * F.col("size") + F.col("inner") + F.col("wrapped")
    return shares(docs, id_col, text_col, source_col).select("doc_id", "source", "size", "source_size", "target", taken.alias("taken"))


def mixed_texts(docs: DataFrame) -> DataFrame:
    """The mix itself, with the columns of ``docs``: a row for each whole turn of a document and for each run of its words."""
    whole = docs.select(F.struct("*").alias("d"), _draw("doc_id", "text").alias("draw")).withColumn(
        "nth", F.row_number().over(Window.partitionBy("draw").orderBy("draw")))
    dealt = shares(docs).select(F.col("draw").alias("at"), "size", "turns", "first", "inner", "wrapped").withColumn(
        "n", F.row_number().over(Window.partitionBy("at").orderBy("turns", "first", "inner", "wrapped")))

    def run(start, count):
        return F.struct(start.cast("long").alias("start"), count.cast("long").alias("count"))

    turns = F.array_repeat(run(F.lit(0), F.col("size")), F.col("turns").cast("int"))
    parts = F.filter(F.array(run(F.col("first"), F.col("inner")), run(F.lit(0), F.col("wrapped"))), lambda x: x["count"] > 0)
    rows = (whole.join(dealt, (F.col("draw") == F.col("at")) & (F.col("nth") == F.col("n")))
            .select("d", "size", F.explode(F.concat(turns, parts)).alias("x")).where("x.count > 0"))
    # words with the white space behind them, so that a run keeps its lines
    pieces = F.split(F.regexp_replace("d.text", "^" + SPACES, ""), r"(?<=[\x20\x09-\x0D])(?=[^\x20\x09-\x0D])")
    cut = F.array_join(F.slice(pieces, (F.col("x.start") + 1).cast("int"), F.col("x.count").cast("int")), "")
    text = F.when(F.col("x.count") == F.col("size"), F.col("d.text")).otherwise(cut)
    return rows.select("d", text.alias("t")).select(*with_text(docs, F.col("t"), "d."))
