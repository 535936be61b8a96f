from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from stratawork.operators import keyed_table as K
from stratawork.operators import upsert as U

COLUMNS = "file_id string, path string, size bigint, review string, note string, status string"
POLICY = {"size": U.OVERWRITE, "review": U.KEEP_FILLED, "note": U.IF_FILLED}


def files(path):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, fs in os.walk(path) for f in fs if f.startswith("part-")}


def table(spark, path):
    return {r["path"]: tuple(r)[:1] + tuple(r)[2:] for r in K.read(spark, path).select(*(c.split()[0] for c in COLUMNS.split(", "))).collect()}


def test_upsert_rewrites_what_it_touches(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = [(f"F{k:05d}", f"D:\\Files\\a{k}.txt", k, "ok" if k % 2 else "", "old", "New") for k in range(1, 61)]
    K.create(spark.createDataFrame(rows, COLUMNS), path, "path", 32)
    before = files(path)
    source = [
        ("d:/files/A1.TXT", 100, "changed", "", 1), ("D:/files/a2.txt/", 200, "set", "new", 2), ("d:\\files\\a2.txt", 201, "last", "newest", 3),
        ("E:\\New\\z.doc", 7, None, "n", 5), ("e:/new/Z.doc", 8, "r", "n2", 6), ("E:/other.doc", 9, "", "", 4),
    ]
    s = spark.createDataFrame(source, "path string, size bigint, review string, note string, at int").repartition(3)
    done = K.upsert_into(spark, path, s, "path", POLICY, "at", id_col="file_id", buckets=32)
    assert (done["inserted"], done["updated"]) == (2, 2) and 1 <= done["buckets"] <= 4
    got, want = table(spark, path), {r[1]: (r[0], *r[2:]) for r in rows}
    want["D:\\Files\\a1.txt"] = ("F00001", 100, "ok", "old", "New")
    want["D:\\Files\\a2.txt"] = ("F00002", 201, "last", "newest", "New")
    want["E:/other.doc"] = ("F00061", 9, "", "", None)
    want["e:/new/Z.doc"] = ("F00062", 8, "r", "n2", None)
    assert got == want
    after = files(path)
    untouched = {f: t for f, t in before.items() if after.get(f) == t}
    assert len({os.path.dirname(f) for f in before} - {os.path.dirname(f) for f in untouched}) <= done["buckets"] and len(untouched) > 10
    assert K.upsert_into(spark, path, s.limit(0), "path", POLICY, "at", buckets=32) == {"inserted": 0, "updated": 0, "buckets": 0}
    for bad in (None, " "):
        with pytest.raises(ValueError, match="without a path"):
            K.upsert_into(spark, path, s.union(spark.createDataFrame([(bad, 1, "", "", 9)], s.schema)), "path", POLICY, "at", buckets=32)
    assert files(path) == after


def test_signals_and_status(spark, tmp_path):
    """Signals go to every column but the protected ones; a status goes to known keys alone."""
    path = str(tmp_path / "t")
    K.create(spark.createDataFrame([("F00001", "a/b", 1, "kept", "n", "New"), ("F00002", "a/c", 2, "", "n", "New")], COLUMNS), path, "path", 8)
    s = spark.createDataFrame([("A/B", 5, "overwritten?", None, 1)], "path string, size bigint, review string, note string, at int")
    policy = K.signals(["size", "review", "note"], ("review",))
    K.upsert_into(spark, path, s, "path", policy, "at", protected=("review",), buckets=8)
    assert table(spark, path) == {"a/b": ("F00001", 5, "kept", None, "New"), "a/c": ("F00002", 2, "", "n", "New")}
    keys = spark.createDataFrame([("A\\C",), ("no/such",), ("a/c/",)], "path string")
    assert K.advance_status(spark, path, keys, "path", "status", "Triaged", 8)["inserted"] == 0
    assert table(spark, path) == {"a/b": ("F00001", 5, "kept", None, "New"), "a/c": ("F00002", 2, "", "n", "Triaged")}
