"""Trees walked level by level."""

from __future__ import annotations

import os

from stratawork.sources import readers


def _found(df):
    return sorted((r.kind, r.path, r.depth, r.files, r.subdirs, r.size_bytes) for r in df.collect())


def test_levels_give_what_a_walk_gives(spark, tmp_path):
    for k in range(12):
        d = tmp_path / "root" / "one" / f"a{k}" / "b"
        d.mkdir(parents=True)
        (d / "x.txt").write_text("x" * k)
    (tmp_path / "root" / "one" / "top.txt").write_text("t")
    os.symlink(tmp_path / "root" / "one", tmp_path / "root" / "link")
    root = str(tmp_path / "root")
    spark.dataSource.register(readers.WalkSource)
    plain = spark.read.format("walk").option("path", root)
    assert _found(readers.walk_levels(spark, [root])) == _found(plain.load()) and len(_found(plain.load())) == 1 + 1 + 24 + 13
    for depth in (0, 1, 2):
        assert _found(readers.walk_levels(spark, [root], depth)) == _found(spark.read.format("walk").option("path", root).option("depth", depth).load())


def test_one_deep_root_is_read_by_many_tasks(spark, tmp_path):
    for k in range(40):
        d = tmp_path / "only" / "sub" / f"d{k:02d}"
        d.mkdir(parents=True)
        (d / "f").write_text("f")
    df = readers.walk_levels(spark, [str(tmp_path / "only")], tasks=8)
    files = df.filter("kind = 'file'").selectExpr("_metadata.file_name as n", "name").collect()
    assert len(files) == 40 and len({r.n for r in files}) > 4


def test_cycles_across_roots_end_and_each_directory_is_walked_once(spark, tmp_path):
    a, b = tmp_path / "a", tmp_path / "b"
    for d in (a / "in", b / "in"):
        d.mkdir(parents=True)
        (d / "f").write_text("f")
    os.symlink(b, a / "to_b")
    os.symlink(a, b / "to_a")
    got = readers.walk_levels(spark, [str(a), str(b), str(a / "to_b"), str(a / "in"), str(tmp_path / "missing")], links=True).collect()
    assert sorted(os.path.realpath(r.path) for r in got if r.kind == "dir") == sorted(map(str, (a, a / "in", b, b / "in")))
    assert sorted(r.real for r in got if r.kind == "file") == [str(a / "in" / "f"), str(b / "in" / "f")]
    assert [r.error for r in got if r.kind == "error"] == ["FileNotFoundError"]
    assert readers.walk_levels(spark, []).collect() == []
