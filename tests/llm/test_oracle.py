"""The queries that SQL can express, against DuckDB on the smallest tables."""

from __future__ import annotations

import duckdb
import pytest

from stratawork.llm import queries

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "embeddings"):
        con.sql(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    got, want = queries.queries()[name](spark, SF).toPandas(), con.sql(queries.oracle_sql()[name]).df()
    cols, key = sorted(want.columns), want.columns[0]
    assert sorted(got.columns) == cols
    got, want = (x[cols].sort_values(key).reset_index(drop=True).astype({c: "float64" for c in cols if x[c].dtype.kind in "iuf"}) for x in (got, want))
    for c in cols:
        a, b = got[c].tolist(), want[c].tolist()
        assert all((x is None or x != x) and (y is None or y != y) or x == y or (isinstance(x, float) and abs(x - y) < 1e-9) for x, y in zip(a, b, strict=True)), c
