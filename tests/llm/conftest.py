from __future__ import annotations

import random

import pytest

WORDS = "the of and sun moon river stone tree light cold warm road bird song deep old new small great under over Élan über mañana".split()


def prose(seed: int, n: int) -> str:
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) + r.choice(["", "", "", ",", "."]) for _ in range(n))


@pytest.fixture(scope="session")
def vocab():
    public_tokenizers = pytest.importorskip("public_tokenizers")
    return public_tokenizers.path


@pytest.fixture(scope="session")
def corpus():
    """(doc_id, text): prose, near and exact copies, null, empty, blanks, one word, a huge text, repeated rows."""
    base = prose(1, 300)
    rows = [(i, prose(100 + i, 20 + 7 * i)) for i in range(20)]
    rows += [(30, base), (31, base + " tail end"), (32, base.replace("sun", "sea", 1)), (33, base), (34, prose(2, 300))]
    rows += [(40, None), (41, ""), (42, " \n\t "), (43, "word"), (44, "word"), (45, "a b c d"), (46, "A B c\nd"), (50, prose(3, 9000)), (50, prose(3, 9000))]
    return rows


@pytest.fixture(scope="session")
def docs(spark, corpus):
    """The corpus beside columns whose names the operators use themselves, and a row of nulls alone."""
    rows = [(i, t, "en", "s", 1, "x", 2, None) for i, t in corpus] + [(None, None, None, None, None, None, None, None)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, id int, c0 string, n_words int, component_id int").repartition(3)
