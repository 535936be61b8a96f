from __future__ import annotations

from stratawork.llm import jaccard_join
from stratawork.llm.support import Scratch
from tests.llm.conftest import prose


def test_each_set_of_a_repeated_id_counts_once_in_the_join(spark):
    """Forty rows an id, as in tables that were appended to themselves; id 3 has two sets of one size."""
    one, other = prose(1, 300), prose(2, 300)
    rows = [(1, one), (2, one + " tail end"), (3, one), (3, other), (4, other)]
    often = spark.createDataFrame(rows * 40, "id bigint, text string").repartition(3)
    ids = spark.createDataFrame([(k,) for k in range(1, 5)], "id bigint")
    pairs = spark.createDataFrame([(1, 2), (1, 3), (1, 4), (3, 4)], "a bigint, b bigint")

    # 296 shingles (id 2: 298) have a prefix of 75, of which id 2 alone holds two
    got = jaccard_join.prefixes(Scratch(spark, "often"), often, ids).groupBy("id").count().collect()
    assert {r.id: r["count"] for r in got} == {1: 75, 2: 73, 3: 150, 4: 75}

    assert sorted(map(tuple, jaccard_join.verify(Scratch(spark, "pairs"), often, pairs, "sets").collect())) == [(1, 2), (1, 3), (3, 4)]


def test_no_text_is_sorted(spark, monkeypatch):
    """Repeated ids are settled by sorting hashes: rows with whole texts in a sort need not fit into a small heap."""
    import re

    import corpus_pipeline
    from stratawork.llm.support import Scratch

    plans, table = {}, Scratch.table

    def watched(self, name, df):
        plans[name] = df._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
        return table(self, name, df)

    monkeypatch.setattr(Scratch, "table", watched)
    rows = [(i % 30, prose(i % 45, 60)) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    kept = corpus_pipeline.near_duplicates(spark, docs, "").collect()
    assert sorted(r["doc_id"] for r in kept) == sorted({r["doc_id"] for r in kept}) and {tuple(r) for r in kept} <= set(rows)
    sorts = [x for name in ("again", "best") for x in re.findall(r"\) (?:Sort|SortAggregate)\b[^\n]*\nInput \[\d+\]: \[([^\n]*)\]", plans.get(name, ""))]
    assert sorts and not any(re.search(r"\btext#", x) for x in sorts)


def test_row_groups_are_bounded(spark, monkeypatch):
    """A task that writes a scratch table holds a row group of a given size in memory, whatever the table's size."""
    from pyarrow import parquet

    from stratawork.llm import support

    monkeypatch.setattr(support, "ROW_GROUP", 1 << 16)
    scratch = support.Scratch(spark, "groups")
    out = scratch.table("t", spark.range(0, 100_000, 1, 1).selectExpr("xxhash64(id) as x"))
    (path,) = (f.removeprefix("file://") for f in out.inputFiles())
    assert parquet.ParquetFile(path).num_row_groups > 4 and out.count() == 100_000
