"""Ordered operators: positions, lags, gap blocks, interruptions, rollover and context."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stratawork.session import written


#: Rows of one key up to which its window is left to one task.
HOT_ROWS = 1 << 22


def is_hot(df: DataFrame, by: list[str], rows: int = HOT_ROWS) -> bool:
    """Whether one key has more rows than a task should see; counted with partial sums."""
    return not df.groupBy(*by).count().filter(F.col("count") > rows).isEmpty()


class Segments:
    """Windows over keys that may span tasks: a segmented prefix scan.

    Rows are sorted by key and order over range partitions and written once
    with their partition and place. Windows run within a partition; what a key
    carries from one partition into the next is joined to it. Only a
    partition's first and last key span partitions, so that table has at most
    two rows a partition, which bounds its broadcast. Rows that repeat key and
    order go to partitions at random and keep the place that they were written in.
    """

    def __init__(self, df: DataFrame, by: list[str], order: list[str], partitions: int | None = None):
        place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
        tied = df.withColumn("__t", F.rand(17))
        keys = [*by, *order, "__t"]
        ranged = tied.repartitionByRange(partitions, *keys) if partitions else tied.repartitionByRange(*keys)
        self.by = by
        self.rows = written(df.sparkSession, ranged.sortWithinPartitions(*keys).drop("__t").withColumn("__p", F.spark_partition_id()).withColumn("__l", place), "segments")
        self.local = W.partitionBy("__p", *by).orderBy("__l")

    def _carried(self, rows: DataFrame, part: Column, over: Column) -> DataFrame:
        """``rows`` with ``__c``: ``over`` the aggregates ``__s`` (``part``) of their key's partitions."""
        each = rows.groupBy("__p", *self.by).agg(part.alias("__s")).withColumn("__k", F.count("*").over(W.partitionBy(*self.by))).filter("__k > 1")
        carry = each.select(F.col("__p").alias("__q"), *(F.col(c).alias(f"__b{i}") for i, c in enumerate(self.by)), over.alias("__c"))
        on = F.col("__p") == F.col("__q")
        for i, c in enumerate(self.by):
            on = on & F.col(c).eqNullSafe(F.col(f"__b{i}"))
        return rows.join(F.broadcast(carry), on, "left").drop("__q", *(f"__b{i}" for i in range(len(self.by))))

    def before(self, rows: DataFrame, value: Column, name: str) -> DataFrame:
        """``name``: the sum of ``value`` over the rows of the key before each."""
        sofar = lambda c, w: F.coalesce(F.sum(c).over(w.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
        valued = rows.withColumn("__v", value)
        out = self._carried(valued, F.sum("__v"), sofar(F.col("__s"), W.partitionBy(*self.by).orderBy("__p")))
        return out.withColumn(name, sofar(F.col("__v"), self.local) + F.coalesce("__c", F.lit(0))).drop("__v", "__c")

    def neighbour(self, rows: DataFrame, columns: list[str], name: str, after: bool = False) -> DataFrame:
        """``name``: the struct of ``columns`` of the row before each in its key, or of the one after; null at the end."""
        row = F.struct(*columns)
        step, edge = (F.lead, F.min_by) if after else (F.lag, F.max_by)
        out = self._carried(rows, edge(row, F.col("__l")), step("__s").over(W.partitionBy(*self.by).orderBy("__p")))
        return out.withColumn(name, F.coalesce(step(row).over(self.local), F.col("__c"))).drop("__c")


def positions(df: DataFrame, by: list[str], order: list[str], at: str, rows: int = HOT_ROWS) -> DataFrame:
    """1-based position in the thread and whole seconds since the row before; a thread of more than ``rows`` spans tasks."""
    if is_hot(df, by, rows):
        s = Segments(df, by, order)
        d = s.neighbour(s.before(s.rows, F.lit(1), "position"), [at], "__prev")
        return d.withColumn("position", F.col("position") + 1).withColumn("lag_seconds", F.timestamp_diff("SECOND", F.col("__prev")[at], F.col(at))).drop("__prev", "__p", "__l")
    w = W.partitionBy(*by).orderBy(*order)
    lag = F.timestamp_diff("SECOND", F.lag(at).over(w), F.col(at))
    return df.withColumn("position", F.row_number().over(w)).withColumn("lag_seconds", lag)


def gap_blocks(df: DataFrame, by: list[str], order: list[str], key: str, gap: Column, threshold: float, rows: int = HOT_ROWS) -> DataFrame:
    """block and reason: a new block where the key changes, else where the gap to the row before reaches the threshold.

    ``gap`` may use ``__prev``, the struct of the row before. A group of more
    than ``rows`` spans tasks.
    """
    reason = F.when(F.col("__prev").isNull(), "start").when(F.col("__prev")[key] != F.col(key), "speaker").when(gap >= threshold, "pause")
    opens = F.when(F.col("reason").isNotNull(), 1).otherwise(0)
    if is_hot(df, by, rows):
        s = Segments(df, by, order)
        out = s.before(s.neighbour(s.rows, df.columns, "__prev").withColumn("reason", reason), opens, "block")
        return out.withColumn("block", F.col("block") + opens).drop("__prev", "__p", "__l")
    w = W.partitionBy(*by).orderBy(*order)
    out = df.withColumn("__prev", F.lag(F.struct(*df.columns)).over(w)).withColumn("reason", reason)
    return out.withColumn("block", F.sum(opens).over(w.rowsBetween(W.unboundedPreceding, 0))).drop("__prev")


def interruptions(df: DataFrame, by: list[str], order: list[str], speaker: str, start: str, end: str, least_gap: float, rows: int = HOT_ROWS) -> DataFrame:
    """interrupted: the next row is another speaker's and starts less than ``least_gap`` after this one ends; a group of more than ``rows`` spans tasks."""
    if is_hot(df, by, rows):
        s = Segments(df, by, order)
        nxt = s.neighbour(s.rows, [speaker, start], "__n", after=True).drop("__p", "__l")
    else:
        nxt = df.withColumn("__n", F.lead(F.struct(speaker, start)).over(W.partitionBy(*by).orderBy(*order)))
    return nxt.withColumn("interrupted", F.coalesce((F.col("__n")[speaker] != F.col(speaker)) & (F.col("__n")[start] - F.col(end) < least_gap), F.lit(False))).drop("__n")


def rollover(df: DataFrame, order: list[str], cap: int, existing: int = 0) -> DataFrame:
    """tab and row of each row in sinks of ``cap`` rows, of which the first holds ``existing`` already.

    Rows are numbered without bringing all to one task. They are sorted by
    range and written once with their partition and place in it; both the
    counting and the numbering read what was written, so they see the same
    partitions whatever the planner or a lost executor does in between. The
    running sums are one number a partition.
    """
    spark = df.sparkSession
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    tied = df.withColumn("__t", F.rand(19))  # rows that repeat the order are dealt out, too
    ranged = tied.repartitionByRange(*order, "__t").sortWithinPartitions(*order, "__t").drop("__t").withColumn("__p", F.spark_partition_id()).withColumn("__l", place)
    ranged = written(spark, ranged, "rollover")
    sizes = ranged.groupBy("__p").agg(F.count("*").alias("__n"))
    before = sizes.select("__p", F.coalesce(F.sum("__n").over(W.orderBy("__p").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("__b"))
    n = ranged.join(F.broadcast(before), "__p", "left").withColumn("__rn", F.col("__b") + F.col("__l") + existing)
    return n.withColumn("tab", F.floor(F.col("__rn") / cap) + 1).withColumn("row_in_tab", F.col("__rn") % cap + 1).drop("__p", "__l", "__b", "__rn")


def numbered(df: DataFrame, order: list[str], name: str = "rn") -> DataFrame:
    """``df`` with a consecutive number from 1 over a whole ordered table, without one task that sees all of it."""
    return rollover(df, order, 1 << 40).withColumnRenamed("row_in_tab", name).drop("tab")


def thinned(df: DataFrame, order: list[str], every: int) -> DataFrame:
    """Each ``every``-th row of a whole ordered table, with its number."""
    return numbered(df, order, "n").filter(F.col("n") % every == 0)


def context(words: Column, hit: Column, around: int = 3) -> Column:
    """Words around place ``hit`` (from 0) of a list."""
    first = F.greatest(hit - around, F.lit(0))
    return F.array_join(F.slice(words, first + 1, hit + around + 1 - first), " ")


def page_starts(df: DataFrame, by: list[str], order: list[str], pages: str, first: int = 2, rows: int = HOT_ROWS) -> DataFrame:
    """The page that each part starts on: those before it and ``first``; a source of more than ``rows`` parts spans tasks."""
    if is_hot(df, by, rows):
        s = Segments(df, by, order)
        return s.before(s.rows, F.col(pages), "page_start").withColumn("page_start", F.col("page_start") + first).drop("__p", "__l")
    w = W.partitionBy(*by).orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    return df.withColumn("page_start", F.coalesce(F.sum(pages).over(w), F.lit(0)) + first)
