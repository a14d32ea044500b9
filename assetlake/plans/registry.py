"""Registry of named queries over the driver's tables.

Each query is a function (spark, data_dir) -> DataFrame and, where the
result is expressible in SQL, an equivalent DuckDB statement used as the
correctness oracle. Queries never collect rows; they return lazy plans.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


def sql_list(values) -> str:
    """A DuckDB list literal of strings, in the given order."""
    return "[" + ", ".join("'" + str(v).replace("'", "''") + "'" for v in values) + "]"


# SQL twin of ``round6``.
def r6(expr: str) -> str:
    return f"(floor(({expr}) * 1e6::DOUBLE + 0.5::DOUBLE) / 1e6::DOUBLE)"


# SQL twin of ``unit_hash(seed, col)``.
def uhash(seed: int, expr: str) -> str:
    return (f"(CAST(CAST('0x' || substr(md5('{seed}:' || coalesce(CAST({expr} AS VARCHAR), '\\N')), 1, 8) AS UBIGINT) AS DOUBLE)"
            f" / 4294967296.0::DOUBLE)")


def split_case(u: str) -> str:
    return f"CASE WHEN {u} < 0.7 THEN 'train' WHEN {u} < 0.85 THEN 'validation' ELSE 'test' END"
