"""Schema kept across runs for sources of JSON texts.

The first run infers a schema over all rows and stores it. Later runs read with the stored one: fields
that it doesn't have go into a map column of rescued values, and a field whose type no longer fits is
refused with the clash named, before any row is read. ``admit`` takes rescued fields into the next
version. Versions are only added.

Inference is one aggregation (``schema_of_variant_agg``) with partial results in every task; a schema
is all that reaches the driver.
"""

from __future__ import annotations

import re

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

LOG = "source string, version int, field string, kind string"
RESCUED = "_rescued"
#: Kinds that values of another kind fit in without loss.
WIDER = {"bigint": {"double"}, "void": None}


class SchemaClash(ValueError):
    """A field came with a type that the stored schema can't hold."""


def _ddl(variant_schema: str) -> str:
    """A variant's schema as a type: objects as structs, decimals as doubles, the unknown as text."""
    s = re.sub(r"DECIMAL\(\d+,\s*\d+\)|FLOAT", "DOUBLE", variant_schema)
    s = re.sub(r"\bOBJECT<>|\bVARIANT\b", "STRING", s)  # an empty object, or mixed kinds, stay as their JSON
    return s.replace("OBJECT<", "STRUCT<")


def inferred(rows: DataFrame, text: str) -> dict[str, str]:
    """field -> kind over all rows. Texts that aren't JSON objects don't count."""
    v = F.try_parse_json(text)
    found = rows.agg(F.schema_of_variant_agg(F.when(_members(v).isNotNull(), v)).alias("s")).first()["s"]
    if found is None or not found.startswith("OBJECT<") or found == "OBJECT<>":
        return {}
    schema = T._parse_datatype_string(_ddl(found))
    return {f.name: f.dataType.simpleString() for f in schema.fields}


def stored(spark: SparkSession, log_path: str, source: str) -> tuple[int, dict[str, str]]:
    """The last version of a source's schema; (0, {}) before the first run."""
    try:
        log = spark.read.schema(LOG).parquet(log_path).where(F.col("source") == source).collect()  # a row a field and version
    except AnalysisException:
        return 0, {}
    last = max((r["version"] for r in log), default=0)
    return last, {r["field"]: r["kind"] for r in log if r["version"] == last}


def _store(spark: SparkSession, log_path: str, source: str, version: int, fields: dict[str, str]) -> None:
    spark.createDataFrame([(source, version, f, k) for f, k in fields.items()], LOG).coalesce(1).write.mode("append").parquet(log_path)


def clashes(known: dict[str, str], now: dict[str, str]) -> dict[str, tuple[str, str]]:
    """field -> (stored kind, new kind) of the fields that don't fit."""
    def fits(new: str, old: str) -> bool:
        return new == old or new == "void" or old in (WIDER.get(new) or ())

    return {f: (known[f], k) for f, k in now.items() if f in known and not fits(k, known[f])}


def read_kept(rows: DataFrame, text: str, source: str, log_path: str, drop_text: bool = True) -> DataFrame:
    """The rows with the stored schema's fields as columns and a map of the fields beyond it.

    The first run stores what it finds. A field that is missing from a row is null; a text that isn't
    a JSON object has nulls and no rescued fields; a name that the rows have already is kept as theirs
    and the field comes under ``text.field``.
    """
    spark = rows.sparkSession
    now = inferred(rows, text)
    version, known = stored(spark, log_path, source)
    wrong = clashes(known, now)
    if wrong:
        raise SchemaClash("; ".join(f"{source}.{f}: {old} is stored, {new} came" for f, (old, new) in sorted(wrong.items())))
    if not version and now:
        known = {f: "string" if k == "void" else k for f, k in now.items()}
        _store(spark, log_path, source, 1, known)
    v = F.try_parse_json(text)
    taken = {f: f if f not in rows.columns else f"{text}.{f}" for f in known}
    fields = [_field(v, f, k).alias(taken[f]) for f, k in known.items()]
    everything = F.from_json(F.when(_members(v).isNotNull(), F.col(text)), "map<string,string>")
    rescued = F.map_filter(everything, lambda k, _: ~k.isin(list(known))) if known else everything
    own = [F.col(f"`{c}`") for c in rows.columns if not (drop_text and c == text)]
    return rows.select(*own, *fields, F.when(F.size(rescued) > 0, rescued).alias(RESCUED))


def _members(v: Column) -> Column:
    """The members of a JSON object; null for other values."""
    return F.try_variant_get(v, "$", "map<string,variant>")


def _field(v: Column, name: str, kind: str) -> Column:
    if re.fullmatch(r"\w+", name):
        return F.try_variant_get(v, f"$.{name}", kind)
    return F.try_variant_get(F.try_element_at(_members(v), F.lit(name)), "$", kind)  # no path spells every name


def admit(rows: DataFrame, text: str, source: str, log_path: str) -> dict[str, str]:
    """Take the fields that these rows have beyond the stored schema into its next version; returns that."""
    version, known = stored(rows.sparkSession, log_path, source)
    now = inferred(rows, text)
    wrong = clashes(known, now)
    if wrong:
        raise SchemaClash(", ".join(sorted(wrong)))
    new = known | {f: "string" if k == "void" else k for f, k in now.items() if f not in known}
    if new != known:
        _store(rows.sparkSession, log_path, source, version + 1, new)
    return new
