"""Every registered query against its DuckDB SQL on the sf0.001 tables."""

import datetime as dt
import decimal
import os

import duckdb
import pytest

import __spark_entry__ as E
from ledgerlens import oracle
from ledgerlens.queries import QUERIES
from conftest import SF_SMALL

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def _norm(v):
    if isinstance(v, float):
        return round(v, 9)
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    return v


def _sort_key(row):
    return tuple((x is None, type(x).__name__ if x is not None else "", x if x is not None else 0) for x in row)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        p = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"create view {t} as select * from read_parquet('{p}')")
    return con


def test_keys_match():
    assert set(QUERIES) == set(oracle.oracle_sql())
    assert set(QUERIES) <= set(E.queries())


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["ORGANIZATION_ID", "DATE", "DAILY_PAYMENT_AMOUNT", "PREV_DAILY_PAYMENT_AMOUNT",
                          "DOD_CHANGE_PCT"]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF_SMALL)
    s_cols = df.columns
    s_rows = sorted((tuple(_norm(v) for v in r) for r in df.collect()), key=_sort_key)
    cur = duck.execute(E.oracle_sql()[name])
    d_cols = [c[0] for c in cur.description]
    assert sorted(s_cols) == sorted(d_cols)
    order = [d_cols.index(c) for c in s_cols]
    d_rows = sorted((tuple(_norm(r[i]) for i in order) for r in cur.fetchall()), key=_sort_key)
    assert s_rows == d_rows
