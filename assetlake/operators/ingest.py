"""Incremental ingest planning.

The surveyed notebook walks a labelled stream row by row, keeping per-key
counters and a high-water mark. Here the same result is a plan over the
whole example table, without a join:

  marks    = one scalar map, wanted key -> last index tried
  examples --marks[key] < idx--> --row_number() over (key order by idx) <= n--> picked rows

The marks are bounded by the wanted keys (a config list). Nothing stands
between the scan and the window, so the top-n plans as WindowGroupLimit in
each map task before the shuffle, and a key that holds a third of all rows
contributes only n rows per task. The plan carries keys, indexes and the
rows' places in their files, never their bytes (``located``, ``fetch``).
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assetlake.functions.columns import asset_filename
from assetlake.operators.rank import dense_ids

STATUS_SCHEMA = T.StructType([
    T.StructField("key", T.StringType()),
    T.StructField("count", T.LongType()),
    T.StructField("last_index", T.LongType()),      # null = legacy row
    T.StructField("last_filename", T.StringType()),
])
#: The stored status also keeps the last index tried, so rows that failed are not tried again.
TRIED = "last_tried"
PLACE = ["source_file", "row_position"]
LISTING_SIZE = 20   # fixed value: status listing shows the first 20 keys


def status_frame(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    return spark.createDataFrame(rows, STATUS_SCHEMA)


def wanted_split(wanted: DataFrame, available: DataFrame, key: str = "key") -> tuple[DataFrame, DataFrame]:
    """(wanted keys present in the source, wanted keys missing)."""
    avail = available.select(F.col(key)).distinct()
    return (wanted.join(avail, key, "left_semi"), wanted.join(avail, key, "left_anti"))


def flag_known(wanted: DataFrame, available: DataFrame, key: str = "key", out: str = "known") -> DataFrame:
    """J3 in one pass: every wanted row with a flag telling whether its key
    occurs in ``available``. The available keys are de-duplicated map-side
    first, so a key held by a third of all rows shuffles one row per task."""
    avail = available.select(F.col(key).alias("_ak")).distinct().withColumn("_hit", F.lit(True))
    j = wanted.join(avail, wanted[key] == avail["_ak"], "left")
    return j.withColumn(out, F.coalesce(F.col("_hit"), F.lit(False))).drop("_ak", "_hit")


def marks(status: DataFrame, wanted: DataFrame) -> Column:
    """A scalar map from each wanted key to its last index tried (unknown/legacy: -1).

    One row for each wanted key, whatever the examples; null keys have no entry.
    """
    tried = F.col(TRIED) if TRIED in status.columns else F.lit(None).cast("bigint")
    seen = status.groupBy(F.col("key").alias("_k")).agg(F.max(F.greatest(F.col("last_index"), tried)).alias("_at"))
    w = wanted.select("key").where(F.col("key").isNotNull()).distinct()
    each = w.join(seen, F.col("key") == F.col("_k"), "left").select("key", F.coalesce("_at", F.lit(-1)).cast("bigint").alias("at"))
    return each.agg(F.map_from_entries(F.collect_list(F.struct("key", "at")))).scalar()


def after_marks(examples: DataFrame, last: Column, key: str = "key", idx: str = "idx") -> DataFrame:
    """Rows of the keys that ``last`` names with an index after it."""
    return examples.filter(F.col(idx) > F.try_element_at(last, F.col(key)))


def first_rows(examples: DataFrame, n: int | Column, key: str = "key", idx: str = "idx", at_most: int | None = None) -> DataFrame:
    """The first ``n`` rows of each key in index order, with their rank. A ``n`` that differs by key needs ``at_most``."""
    win = Window.partitionBy(key).orderBy(idx, *(c for c in PLACE if c in examples.columns))
    ranked = examples.withColumn("rank", F.row_number().over(win)).filter(F.col("rank") <= (at_most or n))
    return ranked if at_most is None else ranked.filter(F.col("rank") <= n)


def plan(examples: DataFrame, status: DataFrame, wanted: DataFrame, n: int,
         key: str = "key", idx: str = "idx") -> DataFrame:
    """The first ``n`` new rows per wanted key, in index order."""
    new = after_marks(examples, marks(status, wanted), key, idx)
    return first_rows(new, n, key, idx).withColumn("filename", asset_filename(F.col(key), F.col(idx)))


def located(examples: DataFrame, key: str = "key", idx: str = "idx") -> DataFrame:
    """Key, index and place (file, row in it) of every example; only (key, index) where they come from no file.

    What is planned on: the scan reads these columns alone.
    """
    slim = [F.col(key).alias("key"), F.col(idx).cast("bigint").alias("idx")]
    try:
        return examples.select(*slim, F.col("_metadata.file_path").alias("source_file"), F.col("_metadata.row_index").alias("row_position"))
    except AnalysisException:
        return examples.select(*slim)


def fetch(examples: DataFrame, picked: DataFrame, content: str = "content", key: str = "key", idx: str = "idx") -> DataFrame:
    """The picked rows with their bytes: only the files that hold them are opened.

    ``picked`` has a bounded number of rows (a few for each wanted key): their files and span of
    indexes become filters of the scan, and the rows are met by their place.
    """
    on = [c for c in ["key", "idx", *PLACE] if c in picked.columns]
    slim = [F.col(key).alias("key"), F.col(idx).cast("bigint").alias("idx"), F.col(content).alias("content")]
    low, high, files = picked.agg(F.min("idx"), F.max("idx"), F.collect_set("source_file") if "source_file" in on else F.lit(None)).first()
    if low is None:
        return picked.withColumn("content", F.lit(None).cast("binary"))
    rows = examples.where(F.col(idx).between(low, high))
    if files is not None:
        rows = rows.where(F.col("_metadata.file_path").isin(files))
        slim += [F.col("_metadata.file_path").alias("source_file"), F.col("_metadata.row_index").alias("row_position")]
    return rows.select(*slim).join(F.broadcast(picked), on)


def merge_status(old: DataFrame, picked: DataFrame, key: str = "key", idx: str = "idx") -> DataFrame:
    """Count += new rows; last index / file name = those of the newest row.

    A legacy row (null last_index) restarts its count at 0, as in the
    surveyed notebook.
    """
    new = picked.groupBy(F.col(key).alias("key")).agg(
        F.count(F.lit(1)).alias("_new"),
        F.max(idx).alias("_last"),
        F.max_by("filename", idx).alias("_file"))
    o = old.select("key", F.when(F.col("last_index").isNull(), F.lit(0)).otherwise(F.col("count")).alias("_old"),
                   "last_index", "last_filename")
    j = o.join(new, "key", "full_outer")
    return j.select(
        "key",
        (F.coalesce(F.col("_old"), F.lit(0)) + F.coalesce(F.col("_new"), F.lit(0))).cast("bigint").alias("count"),
        F.coalesce(F.col("_last"), F.col("last_index")).cast("bigint").alias("last_index"),
        F.coalesce(F.col("_file"), F.col("last_filename")).alias("last_filename"),
    )


def merge_attempts(old: DataFrame, results: DataFrame) -> DataFrame:
    """A13 with what was tried: the merged status and the last index of each key that any write was tried for."""
    tried = results.groupBy("key").agg(F.max("idx").alias("_now"))
    before = (old.groupBy("key").agg(F.max(TRIED).alias("_before")) if TRIED in old.columns
              else old.select("key", F.lit(None).cast("bigint").alias("_before")).distinct())
    done = merge_status(old.select(*STATUS_SCHEMA.names), results.filter(F.col("error").isNull()), key="key", idx="idx")
    # a key may have tries only
    both = done.join(tried, "key", "full_outer").join(before, "key", "left")
    return both.select("key", F.coalesce("count", F.lit(0)).cast("bigint").alias("count"), "last_index", "last_filename",
                       F.greatest("_before", "_now", "last_index").cast("bigint").alias(TRIED))


def run_report(picked: DataFrame, wanted: DataFrame, n: int, key: str = "key") -> DataFrame:
    """Per wanted key: new rows, complete flag, run totals, listing rank.

    Joins the per-key counts (one row per key) with the wanted list; the run
    totals are one aggregated row.
    """
    per = picked.groupBy(F.col(key).alias("key")).agg(F.count(F.lit(1)).alias("new"))
    w = wanted.select("key").where(F.col("key").isNotNull()).distinct()
    r = w.join(per, "key", "left").withColumn("new", F.coalesce(F.col("new"), F.lit(0)).cast("bigint"))
    r = r.withColumn("complete", F.col("new") >= F.lit(n))
    t = r.agg(F.sum("new").cast("bigint").alias("saved"), F.count_if("complete").cast("bigint").alias("done"),
              F.bool_and("complete").alias("all"))
    return (_listed(r).withColumn("_t", t.select(F.struct("*")).scalar())
            .select("key", "new", "complete", F.col("_t.saved").alias("total_saved"), F.col("_t.done").alias("completed_keys"),
                    F.col("_t.all").alias("all_complete"), F.col("listing_rank").cast("int").alias("listing_rank"), "shown", "hidden_keys"))


def _listed(rows: DataFrame) -> DataFrame:
    """Rows of distinct keys with their place in key order, whether the listing shows it, and how many it hides."""
    ids = dense_ids(rows, "key", "_place", kind="bigint")
    hidden = F.greatest(ids.agg(F.count(F.lit(1))).scalar() - F.lit(LISTING_SIZE), F.lit(0)).cast("bigint")
    return (rows.join(ids, "key").withColumn("listing_rank", F.col("_place") + 1).drop("_place")
            .withColumn("shown", F.col("listing_rank") <= LISTING_SIZE).withColumn("hidden_keys", hidden))


def status_listing(status: DataFrame) -> DataFrame:
    """The stored status in key order with the line that the listing prints for each key.

    Legacy rows (null last_index) show the file name that they hold. Every key has its rank; the
    listing shows the first ``LISTING_SIZE``.
    """
    legacy = F.col("last_index").isNull()
    line = F.when(legacy, F.concat(F.coalesce("last_filename", F.lit("N/A")), F.lit(" (old format)"))).otherwise(
        F.concat(F.col("count").cast("string"), F.lit(" images | last_index: "), F.col("last_index").cast("string")))
    rows = status.where(F.col("key").isNotNull()).select("key", "count", "last_index", legacy.alias("legacy"), line.alias("line"))
    return _listed(rows)
