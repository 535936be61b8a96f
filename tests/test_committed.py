"""Loads into a database: all rows or none, and each once."""

from __future__ import annotations

import sqlite3

import pytest
from pyspark.sql import functions as F

from stratawork.sources import committed


@pytest.fixture
def database(tmp_path):
    path = str(tmp_path / "db")

    def connect():
        return sqlite3.connect(path, timeout=120)

    with connect() as con:
        con.execute("create table t (k integer primary key, s text)")
    return connect


def _all(connect, table="t"):
    con = connect()
    try:
        return sorted(con.execute(f"select * from {table}").fetchall())
    finally:
        con.close()


def test_rows_of_all_tasks_are_taken_once(spark, database):
    df = spark.range(0, 503, numPartitions=6).selectExpr("id as k", "case when id % 7 > 0 then 's' || id end as s")
    want = [(k, f"s{k}" if k % 7 else None) for k in range(503)]
    for _ in range(2):  # a load of the same name is taken once
        committed.insert_committed(df, database, "t", "load-1")
        assert _all(database) == want and _all(database, "t_staged") == _all(database, "t_won") == [] and _all(database, "t_commits") == [("load-1", 503)]
    committed.insert_committed(df.filter("k < 0"), database, "t", "empty")
    assert _all(database) == want and ("empty", 0) in _all(database, "t_commits")


def test_a_load_that_fails_leaves_nothing(spark, database):
    @F.udf("string")
    def fails(k):
        if k == 190:
            raise ValueError("lost")
        return str(k)

    df = spark.range(0, 200, numPartitions=2).select(F.col("id").alias("k"), fails("id").alias("s"))
    with pytest.raises(Exception, match="lost"):
        committed.insert_committed(df, database, "t", batch=10)
    assert _all(database) == _all(database, "t_staged") == _all(database, "t_commits") == []


def test_attempts_that_lost_are_not_taken(database):
    steps = committed._Steps(database, "t", ["k", "s"], "insert into", "?", 2)
    steps.prepare()
    rows = [(k, "x") for k in range(5)]

    def killed():
        yield from rows[:4]
        raise KeyboardInterrupt

    with pytest.raises(KeyboardInterrupt):
        steps.stage("r", killed())  # two batches are staged
    steps.stage("r", rows)  # speculative: ran to its end, and lost
    won = steps.stage("r", rows)
    with pytest.raises(RuntimeError, match="staged 5 rows of 6"):
        steps.commit("r", [committed.Staged(won.attempt, 6)])
    assert _all(database) == []
    steps.commit("r", [won, None, committed.Staged("idle", 0)])
    assert _all(database) == rows and _all(database, "t_staged") == []


def test_keys_that_are_there_and_headers(spark, database):
    committed.insert_committed(spark.createDataFrame([(1, "a")], "k int, s string"), database, "t")
    again = spark.createDataFrame([(1, "b"), (2, "c")], "k int, s string")
    with pytest.raises(Exception, match="UNIQUE"):
        committed.insert_committed(again, database, "t", "clash")
    assert _all(database) == [(1, "a")] and _all(database, "t_staged") == []
    committed.insert_committed(again, database, "t", verb="insert or ignore into")
    assert _all(database) == [(1, "a"), (2, "c")]
    committed.insert_committed(again, database, "t", verb="insert or replace into")
    assert _all(database) == [(1, "b"), (2, "c")]
    with pytest.raises(ValueError, match="has the columns"):
        committed.insert_committed(again.select("s", "k"), database, "t")


def test_a_stream_loads_each_batch_once(spark, database, tmp_path):
    source = str(tmp_path / "in")
    schema = "k int, s string"

    def run(checkpoint):
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source)
        committed.stream_committed(stream, database, "t", "feed", str(tmp_path / checkpoint)).awaitTermination()

    spark.createDataFrame([(1, "a"), (2, "b")], schema).coalesce(1).write.parquet(source)
    run("c")
    spark.createDataFrame([(3, "c")], schema).coalesce(1).write.mode("append").parquet(source)
    run("c")
    assert _all(database) == [(1, "a"), (2, "b"), (3, "c")] and _all(database, "t_commits") == [("feed/0", 2), ("feed/1", 1)]
    run("lost-checkpoint")  # both batches run again, under numbers that are done
    assert _all(database) == [(1, "a"), (2, "b"), (3, "c")] and _all(database, "t_staged") == []
