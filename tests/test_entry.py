"""Driver contract: entry, registry, and every query against its DuckDB twin."""

import math

import duckdb
import pytest

import __spark_entry__ as se

SF = "/root/testdata/sf0.001"
TABLES = "documents embeddings pages benchmark labels conversations".split()


def test_entry_runs(spark):
    df = se.entry(spark)
    assert set(df.columns) >= {"category", "asset_count"} and df.count() > 0


def test_every_oracle_has_a_query():
    assert set(se.oracle_sql()) <= set(se.queries())


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(se.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    df = se.queries()[name](spark, SF)
    res = con.execute(se.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(ocols)
    assert _rows(df.columns, df.collect()) == _rows(ocols, res.fetchall())
