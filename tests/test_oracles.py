"""Every bound query against its SQL, and twice under different partitionings where it has none."""

import math

import duckdb
import pytest

from larkspar.plans import bindings

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def shown(v):
    return ("nan" if math.isnan(v) else repr(round(v, 6))) if isinstance(v, float) else str(v)


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", list(bindings.QUERIES))
def test_query(spark, sf, duck, name):
    df = bindings.QUERIES[name](spark, sf)
    columns = sorted(df.columns)
    got = sorted(tuple(shown(r[c]) for c in columns) for r in df.collect())
    if name not in bindings.SQL:
        again = bindings.QUERIES[name](spark, sf).repartition(5)
        assert got == sorted(tuple(shown(r[c]) for c in columns) for r in again.collect())
        return
    found = duck.execute(bindings.SQL[name])
    names = [d[0] for d in found.description]
    assert sorted(names) == columns
    assert got == sorted(tuple(shown(r[names.index(c)]) for c in columns) for r in found.fetchall())


def test_ranked_queries_cut_groups_early(spark, sf):
    assert "WindowGroupLimit" in bindings.QUERIES["top_8"](spark, sf)._jdf.queryExecution().toString()
