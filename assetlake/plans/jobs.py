"""The surveyed pipeline's jobs, wired from parameters and config files.

* ``ingest_job``  -- labelled examples -> asset files + ingest-status table
* ``bronze_job``  -- asset files -> ``{bronze}.bronze_assets`` (one stream, all keys)
* ``silver_job``  -- bronze + decoded images -> ``{silver}.silver_assets`` + ``{silver}.dq_report``
* ``gold_job``    -- silver -> ``{gold}.ml_dataset`` partitioned by split
* ``incremental_job`` -- the three layers per micro-batch (``streaming.incremental``)

Parameters come from ``Params.from_conf`` (``assetlake.*`` session settings);
the taxonomy and key list are JSON files under ``config_path``. Streaming
checkpoints live under ``state_path`` (default: the session's
``spark.checkpoint.dir``, the shared folder the cluster names), never under
the asset root the stream reads.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assetlake.operators.encode import names_lookup, sorted_names
from assetlake.operators.headers import refused
from assetlake.operators.ingest import STATUS_SCHEMA
from assetlake.operators.quality import apply_rules_observed, observed_report
from assetlake.plans.medallion import gold, silver_rows, silver_rules
from assetlake.session import checkpoint_dir
from assetlake.sinks.files import ingest
from assetlake.sinks.tables import append_status, current_status, write_partitioned
from assetlake.sources.config import ConfigError, Params, invert, key_list, taxonomy
from assetlake.sources.files import decoded_images
from assetlake.streaming.bronze import start_bronze
from assetlake.streaming.incremental import start_incremental

NAMED = 10_000
TAXONOMY_FILE = "taxonomy.json"
KEYS_FILE = "keys.json"

# Table properties of the surveyed silver and gold tables, kept as metadata.
SILVER_PROPS = {"quality.rules": "drop+warn", "layer": "silver"}
GOLD_PROPS = {"layer": "gold"}


def _state(spark: SparkSession, p: Params) -> str:
    return p.state_path or checkpoint_dir(spark)


def _db(spark: SparkSession, name: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}")


def config(spark: SparkSession, p: Params) -> tuple[DataFrame, list[str], list[str]]:
    """(key -> group table, sorted keys, sorted groups) from the config files.

    The config is bounded by the 1 MB file cap; the two name lists are
    collected to build literal label maps (as the surveyed jobs do)."""
    tax = taxonomy(spark, os.path.join(p.config_path, TAXONOMY_FILE))
    keys = key_list(spark, os.path.join(p.config_path, KEYS_FILE))
    key_names = sorted_names(r.key for r in keys.select("key").collect())
    groups = sorted_names(r.group for r in tax.select("group").distinct().collect())
    if not key_names or not groups:
        raise ConfigError("empty taxonomy or key list")
    return invert(tax).select("key", "group"), key_names, groups


def ingest_job(spark: SparkSession, p: Params, examples: DataFrame, label_names: list[str],
               wanted: list[str], n: int | None = None):
    """Examples ``(idx, label, content)`` -> the next ``n`` files per wanted
    key under ``bronze_path``; the run's status is appended afterwards."""
    _db(spark, p.bronze_schema)
    table = f"{p.bronze_schema}.ingest_status"
    status = (current_status(spark, table) if spark.catalog.tableExists(table)
              else spark.createDataFrame([], STATUS_SCHEMA))
    ex = names_lookup(examples, "label", label_names, "key").where(F.col("key").isNotNull())
    wanted_df = spark.createDataFrame([(k,) for k in wanted], "key string")
    new_status, results = ingest(ex, status, wanted_df, n or p.images_per_key, p.bronze_path)
    append_status(new_status, table)
    return new_status, results


def bronze_job(spark: SparkSession, p: Params, available_now: bool = True):
    """Start (and, with ``available_now``, drain) the bronze stream."""
    _db(spark, p.bronze_schema)
    ck = os.path.join(_state(spark, p), "streams", f"{p.bronze_schema}.bronze_assets")
    out = os.path.join(_state(spark, p), "tables", f"{p.bronze_schema}.bronze_assets")
    return start_bronze(spark, p.bronze_path, out, ck, p.max_files_per_trigger,
                        table=f"{p.bronze_schema}.bronze_assets", available_now=available_now)


def decodable(spark: SparkSession, root: str, bronze_df: DataFrame) -> DataFrame:
    """Decoded images without the files that their header refuses, as far as a scan's filter can name them.

    Refused files are few as a rule: up to ``NAMED`` of them are taken out of the scan's file list;
    the others are decoded in vain and meet no bronze row. The rows that come out are the same.
    """
    vain = bronze_df.where(F.col("content_present") & refused(F.col("header")))
    names = [r["source_file"] for r in vain.select("source_file").limit(NAMED).collect()]
    images = decoded_images(spark, root)
    return images.where(~F.col("source_file").isin(names)) if names else images


def silver_job(spark: SparkSession, p: Params) -> DataFrame:
    """Batch silver: one image pass; the rule report is observed during the write."""
    _db(spark, p.silver_schema)
    key_to_group, _, _ = config(spark, p)
    bronze_df = spark.table(f"{p.bronze_schema}.bronze_assets")
    rows = silver_rows(bronze_df, decodable(spark, p.bronze_path, bronze_df), key_to_group)
    rules = silver_rules()
    kept, obs = apply_rules_observed(rows, rules, name="silver_dq")
    write_partitioned(kept, f"{p.silver_schema}.silver_assets", ["cuisine_category"],
                      comment="Silver: standardised images with statistics", properties=SILVER_PROPS)
    report = observed_report(spark, obs, rules).withColumn("run_ts", F.current_timestamp())
    report.write.mode("append").format("parquet").saveAsTable(f"{p.silver_schema}.dq_report")
    return report


def gold_job(spark: SparkSession, p: Params) -> None:
    _db(spark, p.gold_schema)
    _, keys, groups = config(spark, p)
    g = gold(spark.table(f"{p.silver_schema}.silver_assets"), keys, groups, seed=p.random_seed)
    write_partitioned(g, f"{p.gold_schema}.ml_dataset", ["dataset_split"],
                      comment="Gold: labelled, split dataset for training", properties=GOLD_PROPS)


def incremental_job(spark: SparkSession, p: Params, out_root: str, available_now: bool = True):
    key_to_group, keys, groups = config(spark, p)
    ck = os.path.join(_state(spark, p), "streams", "incremental")
    return start_incremental(spark, p.bronze_path, out_root, ck, key_to_group, keys, groups,
                             seed=p.random_seed, max_files=p.max_files_per_trigger, available_now=available_now)
