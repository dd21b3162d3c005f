"""The driver contract: entry() runs, and every registered query equals its
DuckDB oracle at sf0.001 (row count, column names, value hash)."""

import datetime as dt
import decimal
import os

import duckdb
import pytest

import __spark_entry__ as E
from legwise.plans.catalog import QUERIES

from conftest import SF_SMALL

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def norm(v):
    if isinstance(v, float):
        return round(v, 9)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 9)
    if isinstance(v, (bytes, bytearray, memoryview)):
        return bytes(v).hex()
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    return v


def canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(repr([norm(r[i]) for i in order]) for r in rows)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        p = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns[:5] == ["trip_date", "Origin_BG", "Dest_BG", "service_group", "provider_name"]


def test_every_core_query_has_an_oracle():
    """Optional queries may lack SQL; their own test folder compares those
    with brute force (tests/llm/test_registered.py keeps the list)."""
    assert set(QUERIES) <= set(E.oracle_sql())
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("key", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, duck, key):
    df = E.queries()[key](spark, SF_SMALL)
    s_cols, s_rows = df.columns, [tuple(r) for r in df.collect()]
    cur = duck.execute(E.oracle_sql()[key])
    o_cols, o_rows = [d[0] for d in cur.description], cur.fetchall()
    assert sorted(s_cols) == sorted(o_cols)
    assert len(s_rows) == len(o_rows)
    assert canon(s_cols, s_rows) == canon(o_cols, o_rows)
