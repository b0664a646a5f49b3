"""Every registered query of the library's own operators, with its SQL where SQL can express it."""

from __future__ import annotations

QUERIES: dict = {}
SQL: dict[str, str] = {}


def table(spark, sf_dir: str, name: str):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def query(name: str, sql: str | None = None):
    """Register a function (spark, sf_dir) -> DataFrame under a name, with its oracle."""
    def add(f):
        QUERIES[name] = f
        if sql is not None:
            SQL[name] = sql
        return f
    return add
