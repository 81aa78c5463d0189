"""The queries with SQL against DuckDB, and the pipeline against its stages' rules."""

import duckdb
import pytest

from shapeloom.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(n for n, q in QUERIES.items() if q.oracle))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "labels", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    res = con.execute(QUERIES[name].oracle)
    names = [d[0] for d in res.description]
    columns = sorted(names)
    key = lambda r: repr([r[c] for c in columns])
    want = sorted(({c: r[names.index(c)] for c in columns} for r in res.fetchall()), key=key)
    got = QUERIES[name].build(spark, SF)
    assert sorted(got.columns) == columns
    rows = sorted((r.asDict() for r in got.select(*columns).collect()), key=key)
    assert rows and rows == want
