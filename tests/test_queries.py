"""Every registered query runs on sf0.001 and matches its DuckDB oracle."""

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF001

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return c


def _norm(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, (int, float)):
        return float(v)
    return v


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "image_id" in df.columns


# the corpus operators have tests of their own
@pytest.mark.parametrize("name", sorted(set(E.queries()) - set(E.LLM_QUERIES)))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF001)
    got = [tuple(_norm(r[c]) for c in sorted(df.columns)) for r in df.collect()]
    sql = E.oracle_sql().get(name)
    if sql is None:
        assert got and len(set(df.columns)) == len(df.columns)
        return
    o = con.execute(sql)
    cols = [d[0] for d in o.description]
    assert sorted(cols) == sorted(df.columns)
    idx = [cols.index(c) for c in sorted(cols)]
    want = [tuple(_norm(r[i]) for i in idx) for r in o.fetchall()]
    key = lambda t: tuple((x is None, str(x)) for x in t)
    assert sorted(got, key=key) == sorted(want, key=key)
