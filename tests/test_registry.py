"""Every registered query equals its DuckDB oracle (multiset of rows, same column names)."""

import datetime as dt
import math
import os
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry
from testdata_dirs import SF_SMALL
from tremor import registry

NAMES = sorted(registry.REGISTRY)


def norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    return None if v is None else str(v)


def multiset(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return Counter(tuple(norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in os.listdir(SF_SMALL):
        if f.endswith(".parquet"):
            con.execute(f"create view {f[:-8]} as select * from read_parquet('{SF_SMALL}/{f}')")
    return con


def test_every_query_has_an_oracle():
    assert set(NAMES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, duck, name):
    df = entry.queries()[name](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    rel = duck.sql(entry.oracle_sql()[name])
    assert sorted(df.columns) == sorted(rel.columns)
    assert multiset(df.columns, rows) == multiset(rel.columns, rel.fetchall())


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "EventID" in df.columns
