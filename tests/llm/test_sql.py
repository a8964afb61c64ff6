"""The queries with SQL against DuckDB on the smallest tables, and on rows with nulls and copies."""

import os

import duckdb
import pytest

from scriptorium.llm import registry

DATA = "/root/testdata/sf0.001"


def rows(columns, found):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(r[i] for i in order) for r in found), key=repr)


def same(spark, name, folder):
    con = duckdb.connect()
    for f in os.listdir(folder):
        if f.endswith(".parquet"):
            path = f"{folder}/{f}" if os.path.isfile(f"{folder}/{f}") else f"{folder}/{f}/*.parquet"
            con.execute(f"create view {f.removesuffix('.parquet')} as select * from '{path}'")
    found, wanted = registry.QUERIES[name](spark, folder), con.sql(registry.ORACLES[name])
    assert sorted(found.columns) == sorted(wanted.columns)
    assert rows(found.columns, found.collect()) == rows(wanted.columns, wanted.fetchall())


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_query_matches_sql(spark, name):
    same(spark, name, DATA)


def test_near_copies_and_pages_with_nulls_match_sql(spark, tmp_path):
    long = " ".join(f"w{i}" for i in range(60))
    texts = [None, "", " \t\n", "One", "one", "a b", "A  b", long, long + " end", "start " + long, long.upper(), "é É", "é É x"]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, f"http://a.example/{i}", t) for i, t in enumerate(texts + ["", None, long])], "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    same(spark, "op3_near_dedup", str(tmp_path))
    same(spark, "op6_warc", str(tmp_path))
