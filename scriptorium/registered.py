"""The registry of queries (spark, sf_dir) -> DataFrame and of the SQL that gives the same rows."""

from __future__ import annotations

QUERIES: dict = {}
ORACLES: dict = {}


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def query(sql: str | None = None, name: str | None = None):
    """Registers a query (spark, sf_dir) -> DataFrame and the SQL for the same rows."""

    def add(f):
        QUERIES[name or f.__name__] = f
        if sql:
            ORACLES[name or f.__name__] = sql
        return f

    return add
