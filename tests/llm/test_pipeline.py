from __future__ import annotations

import pytest
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
corpus_pipeline = pytest.importorskip("corpus_pipeline")


def test_stages(spark, tmp_path):
    from stratawork.llm.jaccard_join import jaccard_components

    read = docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = docs.limit(3).withColumn("text", F.lit(None).cast("string")).withColumn("doc_id", F.lit(None).cast("bigint"))
    docs = docs.union(odd).union(docs.limit(2)).withColumn("__keep", F.lit(1)).withColumn("component_id", F.lit(None).cast("int"))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns
        out.write.parquet(str(tmp_path / name))
        before, docs = docs, spark.read.parquet(str(tmp_path / name))
        assert 0 < docs.count() < before.count() or name == "quality_classifier"
        assert docs.exceptAll(before).count() == 0
    assert jaccard_components(docs).filter("component_id <> doc_id").count() == 0
    assert docs.groupBy("doc_id").count().filter("count > 1").count() == 0
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert last.select("doc_id").distinct().count() == docs.count()
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    kept = docs.join(labels, "doc_id")
    assert kept.filter("quality = 0").count() <= 0.05 * max(1, kept.count())
    assert read.count() > docs.count()


def test_empty_tables(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF).count() == 0


def test_run_is_registered(spark):
    import __spark_entry__

    assert "pipeline" in __spark_entry__.queries()
    assert corpus_pipeline.run(spark, SF).count() > 0


def test_repeated_ids_are_one_document(spark):
    """An id that most rows share, rows that differ in text or in other columns only, whole repeats, and ids that are null."""
    from tests.llm.conftest import prose

    texts = [prose(900 + i, 60) for i in range(6)]
    rows = [(7, texts[0], "a")] * 30 + [(7, texts[1], "a"), (7, texts[0], "b"), (8, texts[2], "a"), (8, texts[2], "a"), (9, texts[3], "a"), (None, texts[4], "a"), (None, texts[4], "a"), (10, texts[5], "a"), (11, texts[5] + " tail", "a")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, `b.h` string").repartition(3)
    got = [tuple(r) for r in corpus_pipeline.near_duplicates(spark, docs, SF).collect()]
    assert sorted(str(r[0]) for r in got) == ["10", "7", "8", "9", "None", "None"]
    assert set(got) <= set(rows)
    again = [tuple(r) for r in corpus_pipeline.near_duplicates(spark, docs.repartition(2), SF).collect()]
    assert sorted(map(str, got)) == sorted(map(str, again))


def test_stages_take_megabytes(spark):
    """A text of megabytes among small ones, whole through all stages."""
    from tests.llm.conftest import prose

    huge = prose(5, 300_000)
    docs = spark.createDataFrame([(1, huge, "en", "s", 1), (2, prose(6, 200), "en", "s", 1), (3, huge + " more words at the end", "en", "s", 1)], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    kept = corpus_pipeline.near_duplicates(spark, docs, SF)
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 2]
    from stratawork.llm import quality_rules

    words = {r["doc_id"]: r["n_words"] for r in quality_rules.apply_rules(docs).collect()}
    assert words == {1: 300_000, 2: 200, 3: 300_005}
    packed = corpus_pipeline.pack(spark, kept, SF).groupBy("doc_id").agg(F.sum("length").alias("n")).collect()
    assert {r["doc_id"] for r in packed} == {1, 2} and max(r["n"] for r in packed) > 300_000


def _statistics(text):
    """The classifier's statistics of a text, by plain Python."""
    import regex

    from stratawork.llm.quality_rules import STOP_FORMS, SYMBOLS
    from tests.llm.test_quality import WORD, _counts

    t = text or ""
    n, chars, symbols, dup, repeat = _counts(t)
    words, lines = WORD.findall(t), [x for x in t.split("\n") if WORD.search(x)]
    letters, upper = len(regex.findall(r"\p{L}", t)), len(regex.findall(r"\p{Lu}", t))
    ratio = lambda a, b: a / b if b else 0.0
    assert symbols == sum(c in SYMBOLS for c in t)
    return [n, ratio(chars, n), ratio(symbols, n), ratio(sum(w in STOP_FORMS for w in words), n), ratio(letters, chars), ratio(upper, letters), ratio(dup, len(lines)), ratio(repeat, n)], n, repeat


def test_pipeline_equals_brute_force(spark, vocab):
    """Each stage again over the smallest tables by plain Python: the rows that stay, and every piece of the last stage."""
    import zlib

    import numpy as np
    from tokenizers import Tokenizer

    from stratawork.llm import quality_classifier
    from stratawork.llm.language_id import held_out
    from stratawork.llm.quality_rules import THRESHOLDS
    from tests.llm.test_links import _brute

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = sorted((r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect())
    got = {i: _statistics(t) for i, t in rows}
    names = ["n_words", *(t.measure for t in THRESHOLDS)]
    at = dict(zip(quality_classifier.STATISTICS, range(8), strict=True))
    assert set(names) <= set(at)

    def good(i):
        s, n, repeat = got[i]
        inside = all((t.low is None or s[at[t.measure]] >= t.low) and (t.high is None or s[at[t.measure]] <= t.high) for t in THRESHOLDS)
        return n >= 50 and 100 * repeat <= 50 * n and inside

    model = quality_classifier.train(docs, spark.read.parquet(f"{SF}/labels.parquet"), ~held_out(F.col("doc_id"), 3, 1))
    kept = [(i, t) for i, t in rows if good(i)]
    margins = model.margins(np.array([got[i][0] for i, _ in kept], float))
    kept = [r for r, m in zip(kept, margins, strict=True) if 1 / (1 + np.exp(-m)) >= 0.5]
    first = {i: c for i, (_, c) in _brute(kept).items()}
    kept = [(i, t) for i, t in kept if first[i] == i]
    library, want = Tokenizer.from_file(vocab("word_bpe_49k.json")), []
    for i, t in kept:
        x = np.array([*library.encode(t, add_special_tokens=False).ids, 0], "<u4")
        want += [(i, k, a, len(x[a : a + 2048]), zlib.crc32(x[a : a + 2048].tobytes())) for k, a in enumerate(range(0, len(x), 2048))]
    out = corpus_pipeline.run(spark, SF).collect()
    assert sorted((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in out) == sorted(want)
    fill = {}
    for r in sorted(out, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == fill.get(r["sequence_id"], 0)
        fill[r["sequence_id"]] = r["offset"] + r["length"]
    assert max(fill.values()) <= 2048 and len(fill) <= -(-sum(fill.values()) // 2048) + 1
