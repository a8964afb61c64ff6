"""Every query against its SQL in DuckDB on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from scriptorium import catalogue

DATA = "/root/testdata/sf0.001"


def plain(v):
    return float(f"{v:.9g}") if isinstance(v, float) else v


@pytest.fixture(scope="module")
def sql():
    con = duckdb.connect()
    for f in os.listdir(DATA):
        con.execute(f"create view {f.removesuffix('.parquet')} as select * from '{DATA}/{f}'")
    return con


@pytest.mark.parametrize("name", sorted(catalogue.ORACLES))
def test_query_matches_sql(spark, sql, name):
    found = catalogue.QUERIES[name](spark, DATA)
    names = sorted(found.columns)
    wanted = sql.sql(catalogue.ORACLES[name])
    assert sorted(wanted.columns) == names
    a = sorted((tuple(plain(r[c]) for c in names) for r in found.collect()), key=repr)
    b = sorted((tuple(plain(r[wanted.columns.index(c)]) for c in names) for r in wanted.fetchall()), key=repr)
    assert a == b


def test_entry_gives_rows(spark):
    assert entry.entry(spark).count() > 0
