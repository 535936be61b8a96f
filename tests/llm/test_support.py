from __future__ import annotations

import pytest

from stratawork.llm import support


@pytest.mark.parametrize("scheme", ["file:", "far://host"])
def test_files_in_a_shared_folder(tmp_path, monkeypatch, scheme):
    """Files are written whole and read back, on a local path and on one that only a file system client reaches."""
    from pyarrow import fs

    monkeypatch.setattr(support, "_remote", lambda uri: (fs.LocalFileSystem(), uri.removeprefix("far://host")))
    uri = f"{scheme}{tmp_path}/a/b/c.bin"
    for data in (b"one", b"two, again"):
        support.write_file(uri, data)
        assert support.read_file(uri) == data
    with support.open_reader(uri) as f:
        f.seek(5)
        assert f.read(5) == b"again"
    assert [p.name for p in (tmp_path / "a" / "b").iterdir()] == ["c.bin"]


def test_a_cluster_needs_a_shared_folder(spark, monkeypatch):
    from types import SimpleNamespace

    from stratawork.session import shared_folder

    cluster = SimpleNamespace(conf=SimpleNamespace(get=lambda k, d=None: d), sparkContext=SimpleNamespace(master="spark://x:7077", getCheckpointDir=lambda: None))
    with pytest.raises(RuntimeError, match="checkpoint"):
        shared_folder(cluster)
    assert shared_folder(spark)


def test_batches_are_bounded(spark):
    support.prepare(spark)
    assert int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) <= support.ROWS_A_BATCH
    sizes = spark.range(40).selectExpr("repeat('x', 1000000) as t").coalesce(1).mapInArrow(lambda bs: (_size(b) for b in bs), "n int, size bigint").collect()
    assert sum(r["n"] for r in sizes) == 40 and max(r["size"] for r in sizes) <= support.BYTES_A_BATCH + 2_000_000


def _size(b):
    import pyarrow as pa

    return pa.RecordBatch.from_arrays([pa.array([b.num_rows], pa.int32()), pa.array([b.nbytes], pa.int64())], names=["n", "size"])


def test_stores_by_scheme():
    """A store that the file client does not know, or a path without a scheme, is refused."""
    with pytest.raises(OSError, match="cannot be reached"):
        support.write_file("nowhere://host/x/y.bin", b"1")
    with pytest.raises(ValueError, match="no scheme"):
        support.write_file("/tmp/no-scheme.bin", b"1")
