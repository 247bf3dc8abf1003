"""Every registered query against its DuckDB oracle on sf0.001."""

import datetime as dt
import decimal
import math
import os

import duckdb
import pytest

import __spark_entry__ as entry
from barwise.registry import QUERIES

SF = "/root/testdata/sf0.001"
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]


def _norm(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    return v


def _rows(cols, data):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in data]
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_entry_smoke(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns[:2] == ["ticker_id", "session_date"]


def test_every_query_has_an_oracle_or_is_rows_only():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(QUERIES) - set(entry.oracle_sql()) == set()


@pytest.mark.parametrize("name", sorted(set(entry.oracle_sql()) & set(QUERIES)))
def test_query_matches_oracle(spark, con, name):
    df = entry.queries()[name](spark, SF)
    cols, data = df.columns, df.collect()
    cur = con.execute(entry.oracle_sql()[name])
    dcols = [d[0] for d in cur.description]
    assert sorted(cols) == sorted(dcols)
    assert _rows(cols, data) == _rows(dcols, cur.fetchall())


def test_rows_only_query_runs(spark):
    assert entry.queries()["file_sample"](spark, SF).count() >= 1
    assert os.path.exists(f"{SF}/lineitem.parquet")
