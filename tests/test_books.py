"""Workbooks written by tasks, with a commit that lists them."""

from __future__ import annotations

import json
import os

import pytest
from pyspark.sql import functions as F

from stratawork.sources import workbooks


def _cells(spark, path):
    return sorted((os.path.basename(r.path), r.sheet, r.row, r.cells) for r in workbooks.read_cells(spark, path).collect())


def test_books_hold_all_rows_in_order_and_grow(spark, tmp_path):
    path = str(tmp_path / "books")
    df = spark.range(0, 23).select((22 - F.col("id")).alias("k"), F.when(F.col("id") % 3 > 0, F.concat(F.lit("=t\x01"), "id")).alias("s"))
    assert workbooks.write_books(df, path, ["k"], 10, "t", sheet_rows=7) == [("book-000001.xlsx", 10), ("book-000002.xlsx", 10), ("book-000003.xlsx", 3)]
    cells = _cells(spark, f"{path}/*.xlsx")
    assert [(b, s) for b, s, n, _ in cells if n == 1] == [("book-000001.xlsx", "t"), ("book-000001.xlsx", "t_2"), ("book-000002.xlsx", "t"), ("book-000002.xlsx", "t_2"), ("book-000003.xlsx", "t")]
    assert [int(c[0]) for *_, n, c in cells if n > 1] == list(range(23))
    assert workbooks.write_books(df.filter("k < 2"), path, ["k"], 10, "t")[3:] == [("book-000004.xlsx", 2)]
    assert workbooks.write_books(df.filter("k < 0"), path, ["k"])[4:] == []
    with pytest.raises(ValueError, match="has the columns"):
        workbooks.write_books(df.select("s", "k"), path, ["k"])
    assert sorted(f for f in os.listdir(path) if not f.endswith(".crc")) == [workbooks.MANIFEST, *(f"book-00000{k}.xlsx" for k in range(1, 5))]


def test_a_load_that_fails_leaves_nothing(spark, tmp_path):
    path = str(tmp_path / "books")

    @F.udf("string")
    def fails(k):
        if k == 17:
            raise ValueError("lost")
        return str(k)

    with pytest.raises(Exception, match="lost"):
        workbooks.write_books(spark.range(20).select("id", fails("id").alias("s")), path, ["id"], 2)
    assert not os.path.exists(path) or os.listdir(path) == []


def test_attempts_that_lost_are_removed(tmp_path):
    writer = workbooks._BookWriter(f"file://{tmp_path}/b", ["k"], "t", 100)

    def killed():
        yield (1, 1, "x")
        raise KeyboardInterrupt

    with pytest.raises(KeyboardInterrupt):
        writer.write(killed())
    writer.write(iter([(1, 1, "lost")]))
    won = writer.write(iter([(1, 1, "a"), (1, 2, "b"), (2, 1, "c")]))
    writer.commit([won, None])
    assert sorted(os.listdir(tmp_path / "b")) == [workbooks.MANIFEST, "book-000001.xlsx", "book-000002.xlsx"]
    assert json.loads((tmp_path / "b" / workbooks.MANIFEST).read_text()) == {"header": ["k"], "books": [["book-000001.xlsx", 2], ["book-000002.xlsx", 1]]}
    writer.abort([])
    assert len(os.listdir(tmp_path / "b")) == 3


def test_a_report_has_a_bound(spark, tmp_path):
    with pytest.raises(ValueError, match="write_books"):
        workbooks.write_workbook({"a": spark.range(6), "b": spark.range(5)}, str(tmp_path / "x.xlsx"), most=10)
    assert workbooks.write_workbook({"a": spark.range(6), "b": spark.range(4)}, str(tmp_path / "y.xlsx"), most=10) == {"a": 6, "b": 4}
    assert not (tmp_path / "x.xlsx").exists()
