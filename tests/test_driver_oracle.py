"""Every registered query against its DuckDB oracle on the sf0.001 tables."""

from __future__ import annotations

import datetime as dt
import decimal
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as E
from ledgerline.sources.driver_views import TABLES

SF = "/root/testdata/sf0.001"


def _norm(v):
    if isinstance(v, decimal.Decimal):
        return str(v.normalize()) if v == v.to_integral() else str(v)
    if isinstance(v, (dt.date, dt.datetime)):
        return v.isoformat()
    if isinstance(v, float):
        return repr(v)
    return None if v is None else str(v)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.parametrize("key", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, duck, key):
    df = E.queries()[key](spark, SF)
    rows, cols = df.collect(), df.columns
    rel = duck.sql(E.oracle_sql()[key])
    ocols, orows = rel.columns, rel.fetchall()
    assert sorted(cols) == sorted(ocols)
    order = sorted(cols)
    got = Counter(tuple(_norm(r[cols.index(c)]) for c in order) for r in rows)
    want = Counter(tuple(_norm(r[ocols.index(c)]) for c in order) for r in orows)
    assert got == want


def test_rows_only_queries_run(spark):
    for key in set(E.queries()) - set(E.oracle_sql()):
        assert E.queries()[key](spark, SF).count() > 0, key


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == [
        "customer_id",
        "customer_name",
        "segment",
        "revenue",
        "product_events",
        "support_tickets",
        "health_score",
    ]
    assert df.count() > 0
