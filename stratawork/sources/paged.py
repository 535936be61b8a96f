"""Sources that are read by (offset, limit): ranges of pages as partitions, and as a stream that resumes at its page."""

from __future__ import annotations

import re
import urllib.parse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from stratawork.operators.windows import numbered
from stratawork.session import own_folder


def paged(fetch, size: int = 1000, at: int = 0, end: int | None = None):
    """Rows from offset ``at`` to ``end``, page after page; without an end until a short page."""
    while end is None or at < end:
        wanted = size if end is None else min(size, end - at)
        page = fetch(at, wanted)
        yield from page
        if len(page) < wanted:
            return
        at += size


def end_of(fetch, known: int = 0, step: int = 1000) -> int:
    """The number of rows of a source of which ``known`` are known: requests of one row at offsets that double, then halve."""
    there = lambda at: len(fetch(at, 1)) > 0
    low, high = known, known
    while there(high):
        low, high, step = high + 1, high + step, step * 2
    while low < high:
        mid = (low + high) // 2
        low, high = (mid + 1, high) if there(mid) else (low, mid)
    return low


class Pages(InputPartition):
    def __init__(self, at: int, end: int | None):
        self.at, self.end = at, end


def _ranges(at: int, end: int, rows: int) -> list[Pages]:
    return [Pages(k, min(k + rows, end)) for k in range(at, end, rows)]


class _Reader(DataSourceReader):
    def __init__(self, fetch, size: int, pages: int):
        self.fetch, self.size, self.pages = fetch, size, pages

    def partitions(self):
        parts = _ranges(0, end_of(self.fetch, 0, self.size), self.size * self.pages) or [Pages(0, 0)]
        parts[-1].end = None  # what came after the count is read, too
        return parts

    def read(self, part):
        return (tuple(r) for r in paged(self.fetch, self.size, part.at, part.end))


class _StreamReader(DataSourceStreamReader):
    """The offset is the number of rows read; a batch that runs again reads the same range."""

    def __init__(self, fetch, size: int, pages: int):
        self.fetch, self.size, self.pages, self.seen = fetch, size, pages, 0

    def initialOffset(self):
        return {"rows": 0}

    def latestOffset(self):
        self.seen = end_of(self.fetch, self.seen, self.size)
        return {"rows": self.seen}

    def partitions(self, start, end):
        return _ranges(start["rows"], end["rows"], self.size * self.pages)

    def read(self, part):
        return (tuple(r) for r in paged(self.fetch, self.size, part.at, part.end))

    def commit(self, end):
        pass


def paged_source(spark: SparkSession, name: str, fetch, schema: str, size: int = 1000, pages: int = 100) -> str:
    """Registers ``fetch(offset, limit)`` (rows in a fixed order, to which new ones are only added) as a source of that name for ``read`` and ``readStream``.

    A partition is a range of ``pages`` requests of ``size`` rows, fetched by
    its task; the driver asks for single rows, as often as the logarithm of
    the source's length. As a stream a trigger takes what is new, and a query
    that starts again goes on where its checkpoint ended. An empty source gives
    no rows.
    """

    class Source(DataSource):
        @classmethod
        def name(cls):
            return name

        def schema(self):
            return schema

        def reader(self, schema):
            return _Reader(fetch, size, pages)

        def streamReader(self, schema):
            return _StreamReader(fetch, size, pages)

    spark.dataSource.register(Source)
    return name


def read_paged(spark: SparkSession, fetch, schema: str, size: int = 1000, pages: int = 100) -> DataFrame:
    """A paged source as a frame."""
    return spark.read.format(paged_source(spark, "paged_rows", fetch, schema, size, pages)).load()


#: Rows of a file of a table that is served by pages.
SHELF = 100_000


def served(spark: SparkSession, df: DataFrame, order: list[str], shelf: int = SHELF):
    """``fetch(offset, limit)`` over a table's rows in order, for sources that give a table by pages: rows are numbered and written to the shared folder, ``shelf`` a folder, and a request reads the row groups of its own."""
    uri = own_folder(spark, "served")
    rows = numbered(df, order, "__n").withColumn("__n", F.col("__n").cast("long") - 1).withColumn("__shelf", F.floor(F.col("__n") / shelf))
    rows.repartition("__shelf").sortWithinPartitions("__shelf", "__n").write.option("parquet.block.size", 1 << 20).partitionBy("__shelf").parquet(uri)
    columns = df.columns

    def fetch(at: int, n: int) -> list[tuple]:
        from pyarrow import dataset, fs

        scheme = urllib.parse.urlparse(uri).scheme
        files, root = fs.FileSystem.from_uri(re.sub("^s3a:", "s3:", uri) if scheme != "file" else "file://" + re.sub("^file:/*", "/", uri))
        out = []
        for k in range(at // shelf, (at + n - 1) // shelf + 1):
            folder = f"{root}/__shelf={k}"
            if files.get_file_info(folder).type != fs.FileType.Directory:
                break
            f = dataset.field("__n")
            t = dataset.dataset(folder, filesystem=files, format="parquet").to_table(columns=[*columns, "__n"], filter=(f >= at) & (f < at + n)).sort_by("__n")
            out += zip(*(t[c].to_pylist() for c in columns))
        return out

    return fetch
