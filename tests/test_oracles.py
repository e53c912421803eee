"""Every registered query against its DuckDB oracle at sf0.01 (the driver's
correctness gate, run locally)."""

import datetime as dt
import math
import os

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF001

QUERIES = E.queries()
ORACLES = E.oracle_sql()


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6) + 0.0
    if isinstance(v, (dt.date, dt.datetime)):
        return v.isoformat()
    return v


def _key(r):
    return tuple((x is None, str(type(x)), x if x is not None else 0) for x in r)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in os.listdir(SF001):
        if t.endswith(".parquet"):
            c.execute(f"CREATE VIEW {t[:-8]} AS SELECT * FROM read_parquet('{SF001}/{t}')")
    return c


def test_every_query_is_registered_and_named():
    assert len(QUERIES) >= 65
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF001)
    rows = [tuple(_norm(x) for x in r) for r in df.collect()]
    cur = con.execute(ORACLES[name])
    ocols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(ocols)
    idx = [ocols.index(c) for c in df.columns]
    orows = [tuple(_norm(r[i]) for i in idx) for r in cur.fetchall()]
    assert len(rows) == len(orows)
    assert sorted(rows, key=_key) == sorted(orows, key=_key)


def test_every_query_has_an_oracle():
    from tidemark.plans import registry  # queries of optional subpackages may have tests of their own instead
    assert set(registry.QUERIES) == set(registry.ORACLES)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "part_idx" in df.columns
