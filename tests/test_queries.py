"""Every registered query with SQL against DuckDB on the smallest tables."""

from __future__ import annotations

import math

import duckdb
import pytest

from stratawork.plans import catalogue

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    return c


def _rows(df):
    def one(v):
        if v is None or (isinstance(v, float) and math.isnan(v)) or str(v) in ("NaT", "<NA>", "nan"):
            return None
        return round(float(v), 5) if isinstance(v, (int, float)) or hasattr(v, "item") else str(v)

    cols = sorted(df.columns)
    return cols, sorted((tuple(one(v) for v in r) for r in df[cols].itertuples(index=False)), key=str)


@pytest.mark.parametrize("name", sorted(catalogue.queries()))
def test_query(spark, con, name):
    got = catalogue.queries()[name](spark, SF).toPandas()
    sql = catalogue.oracle_sql().get(name)
    if sql is None:
        assert len(got) > 0
        return
    assert _rows(got) == _rows(con.sql(sql).df())
