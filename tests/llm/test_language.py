from __future__ import annotations

import math

import numpy as np

from stratawork.llm.language_id import Trees, predict, train
from stratawork.llm.shingles import column_bytes


def _brute(texts, order, text, lang):
    """Code length by the definition, over dictionaries."""
    counts, known = {}, {}
    for k, ts in texts.items():
        stream = b"".join(b"\n" * order + t for t in ts)
        for i in range(order, len(stream)):
            for n in range(order + 1):
                c = counts.setdefault((k, stream[i - n : i]), {})
                c[stream[i]] = c.get(stream[i], 0) + 1
                known[stream[i - n : i]] = known.get(stream[i - n : i], 0) + 1
    size = len({b for ts in texts.values() for t in ts for b in t} | {10}) + 1
    bits, data = 0.0, b"\n" * order + text
    for i in range(order, len(data)):
        n = 0
        while n < order and known.get(data[i - n - 1 : i], 0) >= (4 if n else 4):
            n += 1
        while True:
            c = counts.get((lang, data[i - n : i]), {})
            t, d = sum(c.values()), len(c)
            if data[i] in c:
                bits += math.log2((t + d) / c[data[i]])
                break
            if t:
                bits += math.log2((t + d) / d)
            if n == 0:
                bits += math.log2(size)
                break
            n -= 1
    return bits


def test_code_lengths_equal_the_definition():
    import pyarrow as pa

    texts = {"x": [b"abababac abab", b"abac" * 6], "y": [b"bcbcbc bcb cbb", b"cabc" * 6]}
    t = Trees(texts, {"x": 2, "y": 2}, order=3)
    probe = ["abab zzz", "", "cabcab", "b", "qab\n\nab"]
    bits = t.bits(*column_bytes(pa.array(probe)))
    want = [[_brute(texts, 3, p.encode(), k) for k in t.langs] for p in probe]
    assert np.allclose(bits, want, atol=1e-3)


def test_long_texts_carry_their_context(monkeypatch):
    import pyarrow as pa

    from stratawork.llm import language_id

    t = Trees({"x": [b"the sun and the moon " * 9], "y": [b"die sonne und der mond " * 9]}, {"x": 1, "y": 1})
    probe = pa.array(["the moon und die sonne " * 40, "a", None, "the sun"])
    whole = t.bits(*column_bytes(probe))
    monkeypatch.setattr(language_id, "STRETCH", 50)
    assert np.allclose(t.bits(*column_bytes(probe)), whole, rtol=1e-5)


def test_prediction(spark):
    en, de = "the sun and the moon are over the hill ", "die sonne und der mond sind hinter dem berg "
    rows = [(i, (en if i % 2 else de) * 3, "en" if i % 2 else "de", 0) for i in range(60)] + [(100, None, "en", 0), (101, "", None, 0), (102, "123 !!", "de", 0), (103, "the moon", None, 0), (None, "der mond", None, 0)]
    d = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, score int")
    trees = train(d)
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in predict(d, trees).collect()}
    assert all(got[i][0] == ("en" if i % 2 else "de") for i in range(60))
    assert got[100] == got[101] == got[102] == ("und", 0.0) and got[103][0] == "en" and got[None][0] == "de"
    assert all(0 <= s <= 1 for _, s in got.values())
    assert {r["lang_pred"] for r in predict(d, train(d.limit(0))).collect()} == {"und"}


def test_letters_and_held_out_rows(spark):
    from pyspark.sql import functions as F

    from stratawork.llm.language_id import has_letter, held_out

    assert [has_letter(t) for t in ("\u00b2 \u00bd", "12 _", "\u2167", None, "", "x", "1\u00e9", "\u65e5")] == [False, False, False, False, False, True, True, True]
    d = spark.createDataFrame([(i,) for i in range(40)] + [(None,)], "doc_id bigint")
    import zlib

    got = {r[0]: r[1] for r in d.select("doc_id", held_out(F.col("doc_id"), 4, 2)).collect()}
    assert got == {i: zlib.crc32(str(i).encode()) % 4 == 2 for i in range(40)} | {None: False}


def test_a_language_of_long_texts_is_learned(spark, monkeypatch):
    from stratawork.llm import language_id

    monkeypatch.setattr(language_id, "SAMPLE_DOC_BYTES", 400)
    rows = [(i, "the sun and the moon " * 3, "en") for i in range(20)] + [(100 + i, "der mond und die sonne " * 90, "de") for i in range(20)]
    d = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    trees = train(d)
    assert trees.langs == ["de", "en"]
    assert {r["lang_pred"] for r in predict(d.filter("lang = 'de'"), trees).collect()} == {"de"}


def test_registered_query_predicts_held_out_rows(spark):
    from stratawork.llm import queries

    sf = "/root/testdata/sf0.01"
    got = queries.op3_ppm_language(spark, sf).join(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in got if r["held_out"] and r["lang"] is not None and r["lang_pred"] != "und"]
    assert len(held) > 100 and np.mean([r["lang"] == r["lang_pred"] for r in held]) > 0.99
    assert all(0 <= r["score"] <= 1 for r in got)


def test_null_and_repeated_ids_are_learned(spark):
    """Ids that are all null, one id for all, rows that repeat, and a language of ten rows: a bounded sample of each language."""
    from stratawork.llm import language_id

    sizes = {}

    def learned(rows, **limits):
        kept = {}

        class Spy(Trees):
            def __init__(self, texts, counts, **args):
                kept.update({k: len(v) for k, v in texts.items()})
                super().__init__(texts, counts, **args)

        language_id.Trees, before = Spy, language_id.Trees
        try:
            trees = train(spark.createDataFrame(rows, "doc_id bigint, text string, lang string, h string").repartition(3), **limits)
        finally:
            language_id.Trees = before
        sizes.update(kept)
        return trees, kept

    en, de = [f"the sun and moon {k}" for k in range(3000)], [f"die sonne und mond {k}" for k in range(10)]
    for ids in (lambda k: None, lambda k: 7):
        trees, kept = learned([(ids(k), t, "en", "x") for k, t in enumerate(en)] + [(ids(k), t, "de", "x") for k, t in enumerate(de)])
        assert kept == {"en": language_id.SAMPLE_DOCS, "de": 10} and trees.langs == ["de", "en"]
    trees, kept = learned([(1, "the same text", "en", "x")] * 2000 + [(2, "ein text", "de", "x")])
    assert kept == {"en": 1, "de": 1} and trees.prior[1] < trees.prior[0]
    assert learned([(k, t, "en", "x") for k, t in enumerate(en)], docs=None, chars=None, size=None, nodes=None, table=None)[1] == {"en": 3000}
    assert learned([(k, t, "en", "x") for k, t in enumerate(en)], docs=5, size=40)[1] == {"en": 2}
