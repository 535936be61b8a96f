"""Sources that are read by pages: ranges, ends, and streams that resume."""

from __future__ import annotations

import json

import pytest

from stratawork.sources import paged


def _file_source(path):
    """A source that counts its requests in a file a request."""

    def fetch(at, n):
        with open(path) as f:
            rows = json.load(f)
        return [(k, str(k)) for k in range(rows)[at : at + n]]

    return fetch


@pytest.mark.parametrize("rows", [0, 1, 9, 10, 11, 99, 100, 1000, 12345])
@pytest.mark.parametrize("known", [0, 1, 9])
def test_the_end_is_found_in_few_requests(rows, known):
    asked = []

    def fetch(at, n):
        asked.append((at, n))
        return list(range(rows))[at : at + n]

    if known <= rows:
        assert paged.end_of(fetch, known, 10) == rows and len(asked) < 40 and {n for _, n in asked} == {1}


@pytest.mark.parametrize("rows", [0, 1, 7, 20, 21, 400])
def test_ranges_are_read_by_many_tasks(spark, tmp_path, rows):
    path = tmp_path / "n"
    path.write_text(str(rows))
    df = paged.read_paged(spark, _file_source(str(path)), "k bigint, v string", 7, 3)
    assert sorted((r.k, r.v) for r in df.collect()) == [(k, str(k)) for k in range(rows)]
    assert df.rdd.getNumPartitions() == max(1, -(-rows // 21))


def test_rows_that_come_after_the_count_are_read(spark, tmp_path):
    path = tmp_path / "n"
    path.write_text("30")
    fetch = _file_source(str(path))
    reader = paged._Reader(fetch, 10, 1)
    parts = reader.partitions()
    path.write_text("45")
    assert [r[0] for p in parts for r in reader.read(p)] == list(range(45))


def test_a_stream_goes_on_where_its_checkpoint_ended(spark, tmp_path):
    path = tmp_path / "n"

    def run(rows, crawl):
        path.write_text(str(rows))
        name = paged.paged_source(spark, "resumed_source", _file_source(str(path)), "k bigint, v string", 5, 2)
        q = spark.readStream.format(name).load().selectExpr("k", f"{crawl} as crawl").writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "c"))
        q.trigger(availableNow=True).start().awaitTermination()

    for crawl, rows in enumerate((0, 23, 23, 61)):
        run(rows, crawl)
    got = sorted((r.k, r.crawl) for r in spark.read.parquet(str(tmp_path / "out")).collect())
    assert got == [(k, 1 if k < 23 else 3) for k in range(61)]


def test_a_table_is_served_in_order(spark):
    df = spark.createDataFrame([(k, None if k % 3 else str(k)) for k in range(50, 0, -1)], "k int, v string")
    fetch = paged.served(spark, df, ["k"], 8)
    for at, n in ((0, 1), (7, 2), (0, 50), (45, 100), (50, 1), (1000, 5)):
        assert fetch(at, n) == [(k + 1, None if (k + 1) % 3 else str(k + 1)) for k in range(50)][at : at + n]
    assert paged.served(spark, df.filter("k < 0"), ["k"])(0, 5) == []
