"""Incremental ingestion: micro-batches to row-bounded tabs, and deduplication against what came before."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

BATCH_FILES = 4


def read_stream(spark: SparkSession, path: str, schema, files: int = BATCH_FILES) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(path)


def retry(f: Callable, tries: int = 5, wait: float = 5.0, permanent: tuple[type[Exception], ...] = (ValueError,)):
    """``f()``, again after waits that double; permanent errors are not tried again."""
    for k in range(tries):
        try:
            return f()
        except permanent:
            raise
        except Exception:
            if k == tries - 1:
                raise
            time.sleep(wait * 2**k)


def append_tabs(stream: DataFrame, out: str, checkpoint: str, cap: int, order: list[str]):
    """Appends each micro-batch to ``out``, split at the boundary of tabs of ``cap`` rows.

    A batch is written under its number, so that one that is run again
    replaces itself. The rows up to a batch are kept in a small file a batch
    beside the output: a batch reads the last one below its own number, not
    what was written.
    """
    from stratawork.operators.windows import rollover

    spark = stream.sparkSession

    def rows_before(number: int) -> int:
        if not number:
            return 0
        try:
            r = spark.read.schema("batch bigint, rows bigint").json(f"{out}-counts").filter(F.col("batch") < number).agg(F.max(F.struct("batch", "rows")).alias("x")).first()["x"]
        except Exception as e:  # no batch had rows yet
            if "PATH_NOT_FOUND" not in str(e):
                raise
            return 0
        return r["rows"] if r else 0

    def write(batch: DataFrame, number: int) -> None:
        before = rows_before(number)
        tabs = rollover(batch, order, cap, before)
        retry(lambda: tabs.write.mode("overwrite").parquet(f"{out}/batch={number}"), wait=0.5)
        now = before + spark.read.parquet(f"{out}/batch={number}").count()
        spark.createDataFrame([(number, now)], "batch bigint, rows bigint").coalesce(1).write.mode("overwrite").json(f"{out}-counts/part={number}")

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def first_seen(stream: DataFrame, key: str, at: str, delay: str = "1 day") -> DataFrame:
    """Rows whose key was not seen within the delay: state is bounded by the watermark."""
    return stream.withWatermark(at, delay).dropDuplicatesWithinWatermark([key])


def run_to_end(stream: DataFrame, out: str, checkpoint: str):
    """Appends all that is there and ends."""
    q = stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    return q


def counted(df: DataFrame, name: str = "live") -> tuple[DataFrame, Observation]:
    """A frame and the counters that fill while it is written: rows and bytes of text."""
    text = [F.octet_length(F.col(f"`{n}`")) for n, t in df.dtypes if t == "string"]
    size = F.sum(sum((F.coalesce(c, F.lit(0)) for c in text), F.lit(0)))
    live = Observation(name)
    return df.observe(live, F.count(F.lit(1)).alias("rows"), size.alias("text_bytes")), live


def resumed(todo: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """What an interrupted crawl still has to do: the keys of the first phase that the second has not finished."""
    return todo.select(key).distinct().join(done.select(key), key, "left_anti")


def until_idle(q, seconds: float = 60.0, poll: float = 0.2) -> int:
    """Stops a running query once it has had no new rows for so long; gives the rows that it had."""
    seen, rows, quiet = -1, 0, time.monotonic()
    while q.isActive and time.monotonic() - quiet < seconds:
        for p in q.recentProgress:
            if p["batchId"] > seen and p["numInputRows"]:
                seen, rows, quiet = p["batchId"], rows + p["numInputRows"], time.monotonic()
        time.sleep(poll)
    q.stop()
    if q.exception() is not None:
        raise q.exception()
    return rows
