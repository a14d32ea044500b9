"""Table scans, catalog discovery and unions.

Also maps the driver's parquet tables onto the asset data model, so every
operator runs on data whose size grows with the scale factor:

* ``documents`` -> assets: key = ``source``, group = ``lang``, content =
  UTF-8 bytes of ``text``, path ``/vol/{source}/{source}_idx_{doc_id:06d}.jpg``.
* ``events`` -> labelled example stream: key = ``event_type``, idx = ``event_id``.
"""

from __future__ import annotations

import os
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assetlake.functions.columns import asset_filename

ASSET_ROOT = "/vol"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One parquet table of the data folder (columns pruned by Catalyst)."""
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def document_assets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents seen as binary assets with the file-source base columns."""
    d = read_table(spark, sf_dir, "documents")
    content = F.encode(F.col("text"), "UTF-8")
    return d.select(
        F.col("doc_id"),
        F.concat(F.lit(ASSET_ROOT + "/"), F.col("source"), F.lit("/"),
                 asset_filename(F.col("source"), F.col("doc_id"))).alias("path"),
        F.octet_length(content).cast("bigint").alias("length"),
        content.alias("content"),
        F.col("source").alias("key"),
        F.col("lang").alias("group"),
    )


def union_all(dfs: list[DataFrame]) -> DataFrame:
    """UNION ALL by column name (duplicates kept)."""
    if not dfs:
        raise ValueError("nothing to union")
    return reduce(lambda a, b: a.unionByName(b), dfs)


def tables_with_prefix(spark: SparkSession, prefix: str, database: str | None = None) -> list[str]:
    """Names of catalog tables starting with ``prefix``; error when none."""
    names = sorted(t.name for t in spark.catalog.listTables(database) if t.name.startswith(prefix))
    if not names:
        raise ValueError(f"no tables with prefix {prefix!r}")
    return names


def union_tables(spark: SparkSession, prefix: str, database: str | None = None) -> DataFrame:
    """UNION ALL of every discovered table with the prefix."""
    q = (lambda n: f"{database}.{n}") if database else (lambda n: n)
    return union_all([spark.table(q(n)) for n in tables_with_prefix(spark, prefix, database)])
