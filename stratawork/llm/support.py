"""Shared plumbing of the operators here: scratch tables and files in the folder that all executors share."""

from __future__ import annotations

import io
import os
import re
import uuid
from collections.abc import Iterable, Iterator

from pyspark.sql import DataFrame, SparkSession

from stratawork.session import delete, own_folder, ship

#: Rows and bytes of one Arrow batch; they bound a Python worker's memory, and smaller settings of the session are kept.
ROWS_A_BATCH, BYTES_A_BATCH = 512, 8 << 20
#: Bytes of one row group of a scratch table: each task that writes holds one in memory, and one that reads holds its columns.
ROW_GROUP = 16 << 20


def prepare(spark: SparkSession) -> None:
    """Ships the package and bounds the Arrow batches that carry whole texts, in rows and in bytes.

    The two settings stay lowered in the session, as results are worked out
    after the call that describes them.
    """
    ship(spark)
    for key, most in (("maxRecordsPerBatch", ROWS_A_BATCH), ("maxBytesPerBatch", BYTES_A_BATCH)):
        now = int(re.sub(r"\D", "", spark.conf.get(f"spark.sql.execution.arrow.{key}")) or 0)
        if now > most or now <= 0:
            spark.conf.set(f"spark.sql.execution.arrow.{key}", str(most))


class Scratch:
    """Tables and files of one operator call in the shared folder.

    A table written here cuts the lineage: if an executor is lost, its readers
    read the files again. What a returned DataFrame still reads goes when the
    driver ends, the rest on ``drop``.
    """

    def __init__(self, spark: SparkSession, what: str):
        prepare(spark)
        self.spark = spark
        self.root = own_folder(spark, what)

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def table(self, name: str, df: DataFrame) -> DataFrame:
        df.write.option("parquet.block.size", str(ROW_GROUP)).parquet(self.path(name))
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def sweep(self) -> None:
        """Lets Spark's cleaner find the shuffle files that no table needs any more, which it does when the driver collects its garbage."""
        import gc

        gc.collect()
        self.spark.sparkContext._jvm.System.gc()

    def drop(self, *names: str) -> None:
        for name in names:
            delete(self.spark, self.path(name))


#: Rows of two or three numbers up to which one side of a join is broadcast: some tens of MB.
BROADCAST_ROWS = 1 << 20


def if_small(df: DataFrame, rows: int = BROADCAST_ROWS) -> tuple[DataFrame, bool]:
    """A table of few narrow columns for a join: marked for broadcast if it is counted to be small, else left to a shuffle."""
    from pyspark.sql import functions as F

    small = df.count() <= rows
    return (F.broadcast(df) if small else df), small


def local_path(uri: str) -> str:
    return "/" + re.sub(r"^file:/*", "", uri)


#: Schemes that Spark and the file client call by other names.
_SCHEMES = {"s3a": "s3", "s3n": "s3"}


def _remote(uri: str):
    from pyarrow import fs

    if "://" not in uri:
        raise ValueError(f"{uri} has no scheme: it may be of any file system")
    scheme, rest = uri.split(":", 1)
    try:
        return fs.FileSystem.from_uri(f"{_SCHEMES.get(scheme, scheme)}:{rest}")
    except Exception as e:
        raise OSError(f"files in {uri} cannot be reached from a task: set spark.checkpoint.dir to a folder that is mounted, or of a store that the file client knows") from e


def write_file(uri: str, data: bytes) -> None:
    """Writes whole and then renames, so that a repeated or lost task leaves no half file."""
    tmp = f"{uri}.{uuid.uuid4().hex}"
    if uri.startswith("file:"):
        final, tmp = local_path(uri), local_path(tmp)
        os.makedirs(os.path.dirname(final), exist_ok=True)
        with open(tmp, "wb") as f:
            f.write(data)
        os.replace(tmp, final)
        return
    system, final = _remote(uri)
    _, staged = _remote(tmp)
    system.create_dir(os.path.dirname(final), recursive=True)
    with system.open_output_stream(staged) as f:
        f.write(data)
    system.move(staged, final)


def read_file(uri: str) -> bytes:
    if uri.startswith("file:") or "://" not in uri:  # a plain path is this machine's own
        with open(local_path(uri), "rb") as f:
            return f.read()
    system, path = _remote(uri)
    with system.open_input_stream(path) as f:
        return f.read()


def open_reader(uri: str) -> io.BufferedIOBase:
    """A seekable reader."""
    if uri.startswith("file:") or "://" not in uri:  # a plain path is this machine's own
        return open(local_path(uri), "rb")
    system, path = _remote(uri)
    return system.open_input_file(path)


def rows_of(batches: Iterable, *names: str) -> Iterator[tuple]:
    """The named columns of each Arrow batch as Python lists."""
    for b in batches:
        yield tuple(b.column(b.schema.get_field_index(n)).to_pylist() for n in names)


def slim(df: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns under the operator's own names: others, clashing names included, never enter its plan."""
    from pyspark.sql import functions as F

    return df.select(*(F.col(f"`{old}`").alias(new) for new, old in columns.items()))
