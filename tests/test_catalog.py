"""Every registered query against its SQL oracle (DuckDB) on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from tidemark import catalog
from tidemark.fixtures import TABLES
from conftest import SF_SMALL

import sys
sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))
from check_oracle import canon  # noqa: E402


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle():
    assert set(catalog.QUERIES) == set(catalog.ORACLE_SQL)


def test_entry_registers_every_query():
    assert set(catalog.QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("key", sorted(catalog.QUERIES))
def test_query_matches_oracle(spark, duck, key):
    df = entry.queries()[key](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    res = duck.execute(entry.oracle_sql()[key])
    assert canon(df.columns, rows) == canon([d[0] for d in res.description], res.fetchall())


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() >= 0 and "_action" in df.columns
