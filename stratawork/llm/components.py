"""Connected components of links, by alternating large and small stars."""

from __future__ import annotations

import itertools

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratawork.llm.support import Scratch


def local_forests(links: DataFrame) -> DataFrame:
    """Each task's links as stars (a -> smallest of its group): the same components by fewer links.

    A task holds one batch of links, and one entry for each of its ends, at a time.
    """

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            root: dict[int, int] = {}

            def find(x: int) -> int:
                top = x
                while (up := root.setdefault(top, top)) != top:
                    top = up
                while root[x] != top:
                    root[x], x = top, root[x]
                return top

            for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                a, b = find(a), find(b)
                if a != b:
                    root[max(a, b)] = min(a, b)
            out = [(x, find(x)) for x in root if find(x) != x]
            yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in out], pa.int64()), pa.array([y for _, y in out], pa.int64())], names=["a", "b"])

    return links.select("a", "b").mapInArrow(run, "a bigint, b bigint")


def components(scratch: Scratch, links: DataFrame, name: str = "cc") -> DataFrame:
    """(id, component) of every id that ``links`` (a, b: bigint) joins to a smaller one; component is the smallest.

    Each half round is one aggregate, whose partial sums take in hot ends, and
    one join of written tables, whose hot keys are split at run time. What a
    round reads is in the shared folder; nothing but two numbers a round comes
    to the driver. Loops and repeated links change nothing; no links, no rows.
    """
    edges = links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    edges = scratch.table(f"{name}0", local_forests(edges).distinct())
    digest = lambda df: df.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
    last = digest(edges)
    if not last[0]:
        return edges.select(F.col("a").alias("id"), F.col("b").alias("component"))
    for k in itertools.count(1):  # ends: each round lowers ends, and links are finite
        both = edges.union(edges.select("b", "a"))
        least = scratch.table(f"{name}{k}l", both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m")).select(F.col("a").alias("u"), "m"))
        large = scratch.table(f"{name}{k}s", both.join(least, both["a"] == least["u"]).filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct())
        least2 = scratch.table(f"{name}{k}m", large.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("u"), "m"))
        rest = large.join(least2, large["a"] == least2["u"]).filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        new = scratch.table(f"{name}{k}", rest.union(least2.select("u", "m")).filter("a <> b").distinct())
        scratch.drop(f"{name}{k - 1}", f"{name}{k}l", f"{name}{k}s", f"{name}{k}m")
        edges, now = new, digest(new)
        if now == last:
            break
        last = now
    return edges.select(F.col("a").alias("id"), F.col("b").alias("component"))
