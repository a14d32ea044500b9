"""Asset file sink and the incremental ingest job (K7, K8, T4).

Each selected example is written by the executor that holds it, to a
deterministic target ``{root}/{key}/{key}_idx_{idx:06d}.jpg`` as one atomic
object (``sinks.blob``): a retried task rewrites the same file and a reader
never sees a half-written one. The writer returns one
``(key, idx, path, error)`` row per input row, so failures are data, not
log lines. ``root`` is any URI that every executor reaches; a path without a
scheme belongs to the session's default file system (``blob.shared_root``).

Bytes move late: planning reads keys, indexes and places of rows, and only
the rows that were picked are read again with their content.
"""

from __future__ import annotations

import pandas as pd
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assetlake.operators.ingest import after_marks, fetch, first_rows, located, marks, merge_attempts
from assetlake.functions.columns import asset_filename
from assetlake.sinks import blob
from assetlake.session import checkpoint_dir

WRITE_SCHEMA = T.StructType([
    T.StructField("key", T.StringType()),
    T.StructField("idx", T.LongType()),
    T.StructField("filename", T.StringType()),
    T.StructField("path", T.StringType()),
    T.StructField("error", T.StringType()),
])


def _writer(root: str):
    """Writes rows in the order given. With a column ``need``, a key is left once it has that many files."""
    def run(batches):
        done: dict = {}
        for pdf in batches:
            out = []
            need = pdf["need"] if "need" in pdf else [None] * len(pdf)
            for key, idx, name, content, most in zip(pdf["key"], pdf["idx"], pdf["filename"], pdf["content"], need):
                if most is not None and done.get(key, 0) >= most:
                    continue
                target = blob.join(root, str(key), str(name))
                err = None
                try:
                    if content is None:
                        raise ValueError("no content")
                    blob.put(target, bytes(content))
                    done[key] = done.get(key, 0) + 1
                except Exception as e:  # noqa: BLE001 - recorded per row
                    err = f"{type(e).__name__}: {e}"
                out.append((key, int(idx), name, target, err))
            yield pd.DataFrame(out, columns=[f.name for f in WRITE_SCHEMA.fields])
    return run


def _pinned(rows: DataFrame, root: str) -> DataFrame:
    """Run the writes once; later steps read their outcome from the reliable checkpoint."""
    checkpoint_dir(rows.sparkSession)
    # persisted first, so the checkpoint write reads the results instead of
    # running the writes a second time
    staged = rows.mapInPandas(_writer(blob.shared_root(rows.sparkSession, root)), WRITE_SCHEMA).persist(StorageLevel.MEMORY_AND_DISK)
    pinned = staged.checkpoint(eager=True)
    staged.unpersist()
    return pinned


def write_assets(picked: DataFrame, root: str, key: str = "key", idx: str = "idx",
                 content: str = "content") -> DataFrame:
    """K7: write each row's bytes as a file; one result row per input row."""
    return _pinned(picked.select(F.col(key).alias("key"), F.col(idx).cast("bigint").alias("idx"),
                                 F.col("filename"), F.col(content).alias("content")), root)


def ingest(examples: DataFrame, status: DataFrame, wanted: DataFrame, n: int, root: str,
           key: str = "key", idx: str = "idx", content: str = "content"):
    """T4: one incremental run. Returns (new status, write results).

    The first pass plans the first ``n`` new rows per key and writes them where they are read. Rows
    whose write failed free their slot: each further pass takes, after the last index tried, twice as
    many candidates for a missing file as the pass before, so b bad rows in front cost about log2(b)
    passes; a key's candidates are streamed in order through one task, which stops at the key's last
    missing file. It ends when no key is short or a short key has no rows left.

    The status keeps the last index tried beside the last one saved, so the next run starts behind
    the bad rows. It is pinned before it is returned.
    """
    checkpoint_dir(examples.sparkSession)
    rows = located(examples, key, idx)
    last = marks(status, wanted)

    def candidates(new: DataFrame, most, at_most=None) -> DataFrame:
        picked = first_rows(new, most, at_most=at_most).withColumn("filename", asset_filename(F.col("key"), F.col("idx")))
        return picked.checkpoint(eager=True)  # a few rows for each key

    results = _pinned(fetch(examples, candidates(after_marks(rows, last), n), content, key, idx).select("key", "idx", "filename", "content"), root)
    window = 1
    while True:
        per = results.groupBy("key").agg(F.count_if(F.col("error").isNull()).alias("_ok"), F.max("idx").alias("_tried"))
        short = per.filter(F.col("_ok") < n).select("key", (F.lit(n) - F.col("_ok")).alias("need"), "_tried").checkpoint(eager=True)
        if short.isEmpty():
            break
        window *= 2
        entries = short.agg(F.map_from_entries(F.collect_list(F.struct("key", "_tried"))).alias("tried"),
                            F.map_from_entries(F.collect_list(F.struct("key", "need"))).alias("need"))
        tried, need = entries.select("tried").scalar(), entries.select("need").scalar()
        picked = candidates(after_marks(rows, tried), F.try_element_at(need, F.col("key")) * window, at_most=n * window)
        if picked.isEmpty():
            break
        full = (fetch(examples, picked, content, key, idx).withColumn("need", F.try_element_at(need, F.col("key")))
                .repartition("key").sortWithinPartitions("key", "idx"))
        results = results.unionByName(_pinned(full.select("key", "idx", "filename", "content", "need"), root))
    new_status = merge_attempts(status, results).checkpoint(eager=True)
    return new_status, results
