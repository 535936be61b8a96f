from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from stratawork.llm import quality_classifier as Q
from stratawork.llm import quality_rules as R

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def _counts(t):
    t = t or ""
    w = WORD.findall(t)
    g = Counter(zip(w, w[1:], w[2:], strict=False))
    covered = {i + k for i in range(len(w) - 2) if g[tuple(w[i : i + 3])] > 1 for k in range(3)}
    lines = [x for x in t.split("\n") if WORD.search(x)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(covered)


def test_counts_equal_brute_force(spark, docs, corpus):
    random.seed(5)
    texts = ["a b c a b c", "a a a a", "x\ny\nx\n \n\ny\r", "# $$ |a|", "a\x1cb\x85c d", "a b c d a b c d e a b"] + ["".join(random.choice("ab  \n\t#é") for _ in range(200)) for _ in range(60)]
    d = docs.select("doc_id", "text", "c0").union(spark.createDataFrame([(1000 + i, t, "") for i, t in enumerate(texts)], "doc_id bigint, text string, c0 string"))
    got = R.apply_rules(d).collect()
    want = {**{i: t for i, t in corpus}, **{1000 + i: t for i, t in enumerate(texts)}, None: None}
    assert len(got) == d.count()
    for r in got:
        c = _counts(want[r["doc_id"]])
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == c
        assert r["base_failed"] == (c[0] < 50 or 100 * c[4] > 50 * c[0])
        assert not (r["kept"] and r["base_failed"])
    assert R.apply_rules(d.limit(0)).count() == 0


def test_rows_keep_their_columns(docs):
    verdict = {r["doc_id"]: r["kept"] for r in R.apply_rules(docs).collect()}
    kept = R.kept_documents(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(r["doc_id"] for r in docs.collect() if verdict[r["doc_id"]])


def test_stop_words_count_at_the_start_of_a_sentence(spark):
    d = spark.createDataFrame([(1, "The end. Of it the AND x And")], "doc_id int, text string")
    assert R.apply_rules(d).first()["stop_word_ratio"] == 4 / 8


def test_a_table_of_thresholds(docs):
    strict = (R.Threshold("n_words", 100, 1e6),)
    assert all(r["n_words"] >= 100 for r in R.apply_rules(docs, strict).filter("kept").collect())


def test_results_can_be_filtered_and_joined(docs):
    """A filter or join on a result works its statistics out once; it hung when filters moved below them."""
    verdict = R.apply_rules(docs)
    rows = verdict.collect()
    assert verdict.filter("kept").count() == sum(r["kept"] for r in rows)
    assert verdict.filter("base_failed and n_words > 3").count() == sum(r["base_failed"] and r["n_words"] > 3 for r in rows)
    assert docs.join(verdict.filter("kept").select("doc_id"), "doc_id", "left_semi").count() == sum(r["kept"] for r in rows)
    x, y = _data()
    scored = Q.score(docs, Q.fit(x, y))
    rows = scored.collect()
    assert scored.filter("predicted = 1").count() == sum(r["predicted"] for r in rows)
    assert scored.join(verdict, "doc_id").filter("score > 0.3 and n_words > 0").count() > 0
    assert scored.groupBy("predicted").count().count() == len({r["predicted"] for r in rows})


def test_no_python_in_the_plan(docs):
    assert not re.search("Python|Pandas|Arrow", R.kept_documents(docs)._jdf.queryExecution().executedPlan().toString())


def _data(n=600):
    rng = np.random.default_rng(0)
    x = rng.random((n, len(Q.STATISTICS)))
    return x, ((x[:, 2] < 0.4) & (x[:, 5] < 0.6)).astype(float)


def test_rules_are_learned_and_sparse():
    x, y = _data()
    m = Q.fit(x[:400], y[:400])
    assert (((m.margins(x[400:]) >= 0) == (y[400:] == 1)).mean()) > 0.95
    assert 0 < len(m.rules) < 200


def test_column_equals_model(spark):
    x, y = _data(200)
    m = Q.fit(x, y)
    d = spark.createDataFrame([tuple(map(float, r)) for r in x], list(Q.STATISTICS))
    got = [r[0] for r in d.select(m.column()).collect()]
    assert np.allclose(got, 1 / (1 + np.exp(-m.margins(x))))


@pytest.mark.parametrize("labels,want", [([], 0.5), ([1, 1], 0.99), ([0], 0.01)])
def test_one_class_or_none(labels, want):
    m = Q.fit(np.zeros((len(labels), len(Q.STATISTICS))), np.array(labels, float))
    assert abs(1 / (1 + np.exp(-m.bias)) - want) < 1e-9 and not m.rules


def test_held_out_accuracy(spark):
    from tests.llm.conftest import prose

    rows = [(i, prose(i, 80) if i % 4 else " ".join(w + "%%%" for w in prose(i, 80).split())) for i in range(240)] + [(900, None), (901, "")]
    d = spark.createDataFrame(rows, "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, 1 if i % 4 else 0) for i in range(240)] + [(5, 7), (None, None), (900, 1)], "doc_id bigint, quality int")
    m = Q.train(d, labels, F.col("doc_id") % 3 != 1)
    got = {r["doc_id"]: r for r in Q.score(d, m).collect()}
    held = [i for i in range(240) if i % 3 == 1]
    assert np.mean([got[i]["predicted"] == (1 if i % 4 else 0) for i in held]) > 0.95
    assert 0 <= got[900]["score"] <= 1 and len(got) == len(rows)
    assert {r["score"] for r in Q.score(d, Q.train(d, labels.limit(0), F.lit(True))).collect()} == {0.5}


def test_registered_query_scores_held_out_rows(spark):
    from stratawork.llm import queries

    sf = "/root/testdata/sf0.01"
    got = queries.op9_rule_ensemble(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "quality"), "doc_id").collect()
    held = [r for r in got if r["held_out"]]
    assert len(held) > 50 and np.mean([r["quality"] == r["predicted"] for r in held]) > 0.97
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in got)


def test_repeated_ids_and_long_texts_teach_once(spark, monkeypatch):
    """An id with thousands of labels and documents brings one row a label; nulls bring none."""
    from stratawork.llm import quality_classifier as Q

    seen = []
    monkeypatch.setattr(Q, "fit", lambda x, y: seen.append((len(x), sorted(y.tolist()))) or Q.RuleModel(0.0, ()))
    docs = spark.createDataFrame([(1, f"text {k}", "x") for k in range(500)] + [(2, "word " * 200_000, "x"), (None, "t", "x"), (3, None, "x")], "doc_id bigint, text string, y string")
    labels = spark.createDataFrame([(1, 1)] * 300 + [(1, 0), (2, 1), (3, 0), (None, 1), (4, 1), (2, 5), (3, None)], "doc_id bigint, quality int")
    Q.train(docs, labels, F.lit(True))
    assert seen == [(4, [0.0, 0.0, 1.0, 1.0])]
    assert Q.train(docs, labels.limit(0), F.lit(True)).rules == ()


def test_lasso_conditions():
    """At the optimum the gradient of the loss is within the penalty, and equal to it where a weight is not zero."""
    import numpy as np

    from stratawork.llm.quality_classifier import lasso_logistic

    rng = np.random.default_rng(1)
    r = (rng.random((400, 12)) < 0.4).astype(float)
    y = (rng.random(400) < 1 / (1 + np.exp(-(2 * r[:, 0] - 1.5 * r[:, 1] - 0.3)))).astype(float)
    b, w = lasso_logistic(r, y, 0.02, steps=4000)
    g = (1 / (1 + np.exp(-(r @ w + b))) - y) / len(y)
    grad = r.T @ g
    assert abs(g.sum()) < 1e-6 and (np.abs(grad) <= 0.02 + 1e-6).all()
    assert (w != 0).sum() in range(2, 12) and np.allclose(grad[w != 0], -0.02 * np.sign(w[w != 0]), atol=1e-6)
