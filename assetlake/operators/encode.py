"""Label encoding.

Label ids come from configuration (a sorted list of names -> 0..n-1) or,
for D1b, from the distinct labels present in the data. Lookups never
collect data: a config list becomes a literal map (constant-folded by
Catalyst), a DataFrame of names is joined; ids from data are computed with
the distributed ``dense_ids``.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assetlake.operators.rank import dense_ids

UNKNOWN_ID = -1


def sorted_names(names: Iterable[str]) -> list[str]:
    """Distinct names in ascending order; position = id."""
    return sorted({n for n in names if n is not None})


def label_table(spark: SparkSession, names: Iterable[str]) -> DataFrame:
    """(id int, name string) for a config list, ids by sorted name."""
    rows = [(i, n) for i, n in enumerate(sorted_names(names))]
    schema = T.StructType([T.StructField("id", T.IntegerType(), False),
                           T.StructField("name", T.StringType(), False)])
    return spark.createDataFrame(rows, schema)


def label_map(names: Iterable[str]) -> Column:
    """literal map name -> id."""
    pairs = []
    for i, n in enumerate(sorted_names(names)):
        pairs += [F.lit(n), F.lit(i)]
    return F.create_map(*pairs) if pairs else F.create_map().cast("map<string,int>")


def encode(df: DataFrame, col: str, names, out: str, default: int = UNKNOWN_ID) -> DataFrame:
    """Add ``out`` = id of ``col`` in ``names``; unknown or null -> default.

    ``names`` is a Python list (config) or a DataFrame ``(id, name)``.
    """
    if isinstance(names, DataFrame):
        lut = names.select(F.col("name").alias("_lbl_name"), F.col("id").alias("_lbl_id"))
        return (df.join(lut, df[col] == lut["_lbl_name"], "left")
                .withColumn(out, F.coalesce(F.col("_lbl_id"), F.lit(default)).cast("int"))
                .drop("_lbl_name", "_lbl_id"))
    return df.withColumn(out, F.coalesce(F.try_element_at(label_map(names), F.col(col)),
                                         F.lit(default)).cast("int"))


def decode(df: DataFrame, col: str, names, out: str) -> DataFrame:
    """Inverse of ``encode``: id -> name; unknown ids -> null."""
    names = sorted_names(names)
    arr = F.array(*[F.lit(n) for n in names]) if names else F.array().cast("array<string>")
    idx = F.col(col).cast("int")
    return df.withColumn(out, F.when((idx >= 0) & (idx < len(names)), F.get(arr, idx)))


def labels_from_data(df: DataFrame, col: str) -> DataFrame:
    """(id, name) from the distinct labels present in the rows."""
    return dense_ids(df, col, out="id").withColumnRenamed(col, "name").select("id", "name")


def names_lookup(df: DataFrame, col: str, names: list[str], out: str) -> DataFrame:
    """Integer label -> name through an ordered names array (null when out of range)."""
    arr = F.array(*[F.lit(n) for n in names])
    return df.withColumn(out, F.get(arr, F.col(col).cast("int")))
