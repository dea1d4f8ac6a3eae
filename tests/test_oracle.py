"""Every registered query equals its DuckDB oracle on sf0.001 (whole tables)."""

import datetime as dt
from decimal import Decimal

import duckdb
import pytest

from conftest import SF0001
from stockroom.plans import oracle
from stockroom.plans.registry import all_queries

TABLES = "region nation customer supplier part orders lineitem events".split()
NAMES = sorted(oracle.QUERIES)


def _norm(v):
    if isinstance(v, Decimal):
        return str(v)
    if isinstance(v, float):
        return round(v, 9)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    return v


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF0001}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    assert set(all_queries()) == set(oracle.QUERIES)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    sdf = all_queries()[name](spark, SF0001)
    rel = con.execute(oracle.sql(oracle.QUERIES[name]))
    ocols = [d[0] for d in rel.description]
    assert sorted(sdf.columns) == sorted(ocols)
    cols = sorted(ocols)
    s_idx = [sdf.columns.index(c) for c in cols]
    o_idx = [ocols.index(c) for c in cols]
    srows = sorted((tuple(_norm(r[i]) for i in s_idx) for r in sdf.collect()), key=repr)
    orows = sorted((tuple(_norm(r[i]) for i in o_idx) for r in rel.fetchall()), key=repr)
    assert srows == orows
