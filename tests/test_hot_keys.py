"""Keys that span tasks, alias tables that do not fit, and intervals of very different lengths."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratawork.operators import joins, windows


@pytest.fixture
def uncoalesced(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.shuffle.partitions", "4")


def _rows():
    r = random.Random(8)
    rows = [("hot", k, r.randrange(5), r.randrange(3), f"2024-01-01 {k // 60 % 24:02d}:{k % 60:02d}:00") for k in range(400)]
    rows += [(None, k, 1, k % 2, "2024-01-01 00:00:00") for k in range(30)] + [("x", 1, 9, 1, "2024-01-01 00:00:00")]
    return rows


@pytest.mark.parametrize("partitions", [1, 8, 64])
def test_segments(spark, uncoalesced, partitions):
    """The scan over one hot key equals the window of one task, at any number of partitions."""
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    df = spark.createDataFrame(_rows(), "src string, n int, pages int, spk int, at string").withColumn("at", F.col("at").cast("timestamp_ntz")).repartition(5)
    same = lambda f: [sorted(map(tuple, f(rows).select(*columns).collect()), key=str) for rows in (0, 1 << 40)]
    columns = ["src", "n", "page_start"]
    a, b = same(lambda rows: windows.page_starts(df, ["src"], ["n"], "pages", rows=rows))
    assert a == b and len(a) == 431
    columns = ["src", "n", "block", "reason"]
    a, b = same(lambda rows: windows.gap_blocks(df, ["src"], ["n"], "spk", F.col("n") - F.col("__prev.n"), 2, rows=rows))
    assert a == b
    columns = ["src", "n", "interrupted"]
    a, b = same(lambda rows: windows.interruptions(df, ["src"], ["n"], "spk", "n", "pages", 300, rows=rows))
    assert a == b
    columns = ["src", "n", "position", "lag_seconds"]
    a, b = same(lambda rows: windows.positions(df, ["src"], ["n"], "at", rows=rows))
    assert a == b
    s = windows.Segments(df, ["src"], ["n"])
    assert s.rows.filter("src = 'hot'").select("__p").distinct().count() >= min(partitions, 8) // 2 + (partitions == 1)


def test_equal_order_keys_span_partitions(spark, uncoalesced):
    """Rows that all repeat the order are numbered once each, and not by one task."""
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    df = spark.range(4000).select(F.lit(1).alias("k"), "id")
    assert windows.numbered(df, ["k"]).agg(F.count_distinct("rn"), F.min("rn"), F.max("rn")).first()[:] == (4000, 1, 4000)
    assert windows.Segments(df, ["k"], ["k"]).rows.select("__p").distinct().count() == 8


def test_million_short_aliases(spark, monkeypatch):
    """A million aliases of one word: no row of them comes to the driver."""
    n = 1_000_000
    r = random.Random(2)
    rows = [(k, " ".join(f"{r.randrange(16**5):x}" for _ in range(20)) if k % 9 else None) for k in range(60)]
    texts = spark.createDataFrame(rows, "doc_id bigint, text string")
    aliases = spark.range(n).select(F.col("id").alias("e"), F.concat(F.lit(" "), F.upper(F.lower(F.hex("id")))).alias("alias"))
    most, collect = [0], DataFrame.collect

    def counted(self):
        out = collect(self)
        most[0] = max(most[0], len(out))
        return out

    monkeypatch.setattr(DataFrame, "collect", counted)
    found = joins.containment_join(texts, "doc_id", "text", aliases, "alias", "e")
    assert most[0] <= 4
    monkeypatch.undo()
    want = {(k, int(x, 16)) for k, t in rows for w in (t or "").split() for i in range(len(w)) for x in [w[i : i + m] for m in range(1, 6)] if x[0] != "0" or x == "0" if int(x, 16) < n}
    assert {tuple(x) for x in found.collect()} == want


@pytest.mark.parametrize("few", [0, 100])
def test_aliases_of_any_length(spark, few):
    texts = [(1, "The quick brown fox"), (2, "ÜBER alles und ein c"), (3, ""), (4, None), (5, "aaa " * 50), (6, "a b c")]
    aliases = ["quick brown", "über", "A", "aa a", "b c", "c", "fox ", "none at all", "", None, " the quick brown fox ", "b c"]
    t = spark.createDataFrame(texts, "doc_id bigint, text string")
    a = spark.createDataFrame([(k, x) for k, x in enumerate(aliases)], "e int, alias string")
    want = {(k, e) for k, x in texts for e, y in enumerate(aliases) if y and y.strip() and y.strip().lower() in (x or "").lower()}
    assert {tuple(r) for r in joins.containment_join(t, "doc_id", "text", a, "alias", "e", few=few).collect()} == want
    assert joins.containment_join(t, "doc_id", "text", a, "alias", "e", few=few, size=0).count() == len(want)


def test_intervals_without_length(spark):
    """Points and intervals that end before they start, as the comparisons alone take them: brute force."""
    r = random.Random(5)
    rows = [(k, s := float(r.randrange(-60, 60)), s + r.choice([0.0, -4.0, 2.0, 9.0, 70.0]), r.randrange(3), r.randrange(2)) for k in range(200)] + [(300, None, 3.0, 0, 0), (301, 3.0, None, 0, 0)]
    df = spark.createDataFrame(rows, "id bigint, s double, e double, o int, w int")
    whole = [x for x in rows if None not in x]
    want = sorted((a[0], b[0]) for a in whole for b in whole if a[0] < b[0] and a[1] < b[2] and b[1] < a[2] and a[3] != b[3] and a[4] == b[4])
    assert any(rows[a][1] >= rows[a][2] or rows[b][1] >= rows[b][2] for a, b in want)
    assert sorted(map(tuple, joins.overlapping(df, "id", "s", "e", "o", 1.0, ["w"], empty=True).collect())) == want


def test_intervals_of_any_length(spark):
    """A year beside seconds, ends that touch, equal starts, negative times: brute force, with few rows an interval."""
    r = random.Random(4)
    rows = [(k, s := r.uniform(-5000, 5000), s + r.choice([0.5, 3.0, 50.0, 900.0]), r.randrange(3), r.randrange(2)) for k in range(150)]
    rows += [(200, -1e7, 2e7, 0, 0), (201, -1e7, 2e7, 1, 0), (202, 10.0, 20.0, 0, 0), (203, 20.0, 30.0, 1, 0), (204, 10.0, 12.0, 2, 0), (205, 5.0, 5.0, 1, 0), (206, 7.0, 6.0, 2, 0)]
    df = spark.createDataFrame(rows, "id bigint, s double, e double, o int, w int")
    live = [x for x in rows if x[1] < x[2]]
    want = sorted((a[0], b[0]) for a in live for b in live if a[0] < b[0] and a[1] < b[2] and b[1] < a[2] and a[3] != b[3] and a[4] == b[4])
    assert sorted(map(tuple, joins.overlapping(df, "id", "s", "e", "o", 1.0, ["w"]).collect())) == want
    cells = spark.createDataFrame([(a, b) for a in range(-9, 9) for b in range(a, a + 20)] + [(-10_000_000, 20_000_000)], "a bigint, b bigint")
    for a, b, runs in cells.select("a", "b", joins.dyadic(F.col("a"), F.col("b"))).collect():
        assert len(runs) <= 52
        if b - a < 100:
            assert sorted(c for k, n in runs for c in range(n << k, (n + 1) << k)) == list(range(a, b + 1))
    assert joins.overlapping(df.limit(0), "id", "s", "e", "o", 1.0).count() == 0
