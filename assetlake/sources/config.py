"""Configuration: taxonomy and key list files, pipeline parameters.

A taxonomy is a JSON object group -> [keys]; the key list a JSON array.
Files are read by Spark (so any Hadoop file system works), capped at
1,000,000 bytes like the surveyed loader, and parsed with ``from_json``.
The parsed config is tiny and fixed-size; it becomes DataFrames that are
broadcast into joins.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MAX_CONFIG_BYTES = 1_000_000   # fixed value: the surveyed loader's cap


class ConfigError(ValueError):
    pass


def _read_text(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path, wholetext=True)


def taxonomy(spark: SparkSession, path: str) -> DataFrame:
    """Taxonomy file -> rows (group, key, group_pos, key_pos).

    Raises ConfigError when the file is missing, too large, not a JSON
    object of lists, or empty.
    """
    try:
        raw = _read_text(spark, path)
        parsed = raw.select(
            F.length("value").alias("n"),
            F.from_json("value", "map<string,array<string>>").alias("m"))
        row = parsed.first()
    except Exception as e:  # missing file, unreadable
        raise ConfigError(f"taxonomy not available: {path}: {e}") from e
    if row is None or row["n"] > MAX_CONFIG_BYTES or row["m"] is None or len(row["m"]) == 0:
        raise ConfigError(f"taxonomy empty or invalid: {path}")
    entries = parsed.select(F.posexplode(F.map_entries("m")).alias("group_pos", "e"))
    return (entries.select("group_pos", F.col("e.key").alias("group"),
                           F.posexplode_outer("e.value").alias("key_pos", "key"))
            .select("group", "key", "group_pos", "key_pos"))


def key_list(spark: SparkSession, path: str) -> DataFrame:
    """Key list file -> rows (key, pos)."""
    try:
        raw = _read_text(spark, path)
        parsed = raw.select(F.length("value").alias("n"), F.from_json("value", "array<string>").alias("a"))
        row = parsed.first()
    except Exception as e:
        raise ConfigError(f"key list not available: {path}: {e}") from e
    if row is None or row["n"] > MAX_CONFIG_BYTES or row["a"] is None or len(row["a"]) == 0:
        raise ConfigError(f"key list empty or invalid: {path}")
    return parsed.select(F.posexplode("a").alias("pos", "key")).select("key", "pos")


def invert(tax: DataFrame) -> DataFrame:
    """Key -> group; a key listed in several groups takes the last one.

    ``max_by`` over (group_pos, key_pos) is an aggregation, not a driver
    dict, so the same code handles a taxonomy of any size.
    """
    t = tax.where(F.col("key").isNotNull())
    return t.groupBy("key").agg(
        F.max_by("group", F.struct("group_pos", "key_pos")).alias("group"),
        F.count(F.lit(1)).cast("bigint").alias("n_groups"))


def check(tax: DataFrame, keys: DataFrame) -> DataFrame:
    """Taxonomy vs key list: (key, in_taxonomy, in_key_list) for every key
    present in either file; rows where the two disagree need attention."""
    t = tax.where(F.col("key").isNotNull()).select("key").distinct().withColumn("in_taxonomy", F.lit(True))
    k = keys.where(F.col("key").isNotNull()).select("key").distinct().withColumn("in_key_list", F.lit(True))
    j = t.join(k, "key", "full_outer")
    return j.select("key", F.coalesce("in_taxonomy", F.lit(False)).alias("in_taxonomy"),
                    F.coalesce("in_key_list", F.lit(False)).alias("in_key_list"))


def counts(tax: DataFrame) -> DataFrame:
    """A1: groups, listed keys, distinct keys."""
    return tax.agg(F.count_distinct("group").cast("bigint").alias("groups"),
                   F.count("key").cast("bigint").alias("listed_keys"),
                   F.count_distinct("key").cast("bigint").alias("keys"))


def with_positions(pairs: DataFrame, group: str, key: str) -> DataFrame:
    """Taxonomy rows (group, key, group_pos, key_pos) from a (group, key) table,
    ordered by name (the dense position of each group among the groups).

    The group positions come from the distributed ``dense_ids`` (no
    single-task window); the join is left to AQE, which broadcasts the
    position table only once it has measured it."""
    from assetlake.operators.rank import dense_ids
    gp = dense_ids(pairs, group, out="group_pos")
    return (pairs.join(gp, group)
            .withColumn("key_pos", F.lit(0))
            .select(F.col(group).alias("group"), F.col(key).alias("key"), "group_pos", "key_pos"))


@dataclass
class Params:
    """Pipeline parameters with the surveyed defaults."""
    config_path: str
    bronze_path: str
    bronze_schema: str = "bronze"
    silver_schema: str = "silver"
    gold_schema: str = "gold"
    random_seed: int = 42
    images_per_key: int = 5
    max_files_per_trigger: int = 100
    # where stream checkpoints and stream-written tables live; None = the
    # session's shared spark.checkpoint.dir (kept across runs on purpose:
    # an incremental stream resumes from it)
    state_path: str | None = None

    @classmethod
    def from_conf(cls, spark: SparkSession, prefix: str = "assetlake.") -> "Params":
        def get(k, d=None):
            v = spark.conf.get(prefix + k, d)
            if v is None:
                raise ConfigError(f"missing required parameter {prefix + k}")
            return v
        return cls(config_path=get("config_volume_path"), bronze_path=get("bronze_volume_path"),
                   bronze_schema=get("bronze_schema", "bronze"), silver_schema=get("silver_schema", "silver"),
                   gold_schema=get("gold_schema", "gold"),
                   random_seed=int(get("random_seed", "42")), images_per_key=int(get("images_per_key", "5")),
                   max_files_per_trigger=int(get("max_files_per_trigger", "100")),
                   state_path=spark.conf.get(prefix + "state_path", None))
