"""Every registered query runs on the smallest tables and agrees with its DuckDB oracle."""

import datetime as dt
import math

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from sentiflow.sources.tables import TEST_TABLES


def _norm(v):
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    if isinstance(v, float) and math.isnan(v):
        return "nan"
    return v


def _canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda r: tuple((x is None, str(x)) for x in r))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TEST_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["bucket", "sentiment", "tweet_count", "avg_compound", "total_retweets", "total_likes"]
    assert df.count() > 0


@pytest.mark.parametrize("name", sorted(E.queries()))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF_SMALL)
    rows = _canon(df.columns, [tuple(r) for r in df.collect()])
    sql = E.oracle_sql().get(name)
    if sql is None:
        return
    res = duck.execute(sql)
    cols = [d[0] for d in res.description]
    assert sorted(cols) == sorted(df.columns)
    assert rows == _canon(cols, res.fetchall())
