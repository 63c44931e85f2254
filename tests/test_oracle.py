"""Every registered query against its DuckDB oracle on the smallest tables."""

from __future__ import annotations

import math
import os
from datetime import datetime
from decimal import Decimal

import duckdb
import pytest

import __spark_entry__ as E
from churnlens.oracle_sql import SQL
from churnlens.queries import QUERIES

SF = "/root/testdata/sf0.001"
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    if isinstance(v, Decimal):
        return str(v)
    if isinstance(v, datetime):
        return v.isoformat()
    return repr(v)


def _key(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(SF, t + '.parquet')}')")
    return c


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(E.queries()) and set(SQL) <= set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF)
    srows = [tuple(r) for r in df.collect()]
    res = con.execute(SQL[name])
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    assert len(srows) == len(drows)
    assert _key(df.columns, srows) == _key(dcols, drows)


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns[:2] == ["customer_id", "snapshot_date"]
    assert df.count() > 0
