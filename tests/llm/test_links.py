from __future__ import annotations

import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from stratawork.llm import jaccard_join, vector_links
from stratawork.llm.components import components
from stratawork.llm.sketches import bands, blocks
from stratawork.llm.support import Scratch
from tests.llm.conftest import WORDS, prose

SPLIT = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


class Groups:
    def __init__(self, ids):
        self.root = {i: i for i in ids}

    def find(self, x):
        while self.root[x] != x:
            x = self.root[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self.root[max(a, b)] = min(a, b)


def _set(t):
    w = SPLIT.findall((t or "").translate(LOWER))
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def _brute(rows):
    sets = {i: _set(t) for i, t in rows if i is not None}
    g, ids = Groups(sets), sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            if sets[a] and sets[b]:
                i = len(sets[a] & sets[b])
                if 100 * i >= 75 * (len(sets[a]) + len(sets[b]) - i):
                    g.join(a, b)
    return {i: (len(s), g.find(i)) for i, s in sets.items()}


def _family(rows, first, base, n, edits, seed):
    r = random.Random(seed)
    for k in range(n):
        w = base.split()
        for _ in range(r.randint(0, edits)):
            w[r.randrange(len(w))] = r.choice(WORDS) + str(r.random())
        rows.append((first + k, " ".join(w)))


@pytest.mark.parametrize("hot,cell,joined", [(50, 512, 128), (3, 8, 128), (5, 512, None)])
def test_jaccard_components_equal_brute_force(spark, docs, corpus, monkeypatch, hot, cell, joined):
    monkeypatch.setattr(jaccard_join, "HOT", hot)
    monkeypatch.setattr(jaccard_join, "CELL", cell)
    rows = []
    _family(rows, 1000, prose(7, 200), 40, 9, 1)
    _family(rows, 2000, prose(8, 30), 20, 2, 2)
    shared = prose(9, 60)
    rows += [(3000 + i, prose(500 + i, 40) + " " + shared) for i in range(25)]
    rows += [(4000 + i, shared + " x" * (i % 3)) for i in range(8)]
    rows += [(5000 + i, " ".join(prose(9, 900).split()[: 700 + 40 * i])) for i in range(5)]
    d = docs.select("doc_id", "text").union(spark.createDataFrame(rows, "doc_id bigint, text string"))
    got = jaccard_join.jaccard_components(d, joined=joined).collect()
    assert len(got) == d.count()
    want = _brute([*corpus, *rows])
    for r in got:
        if r["doc_id"] is None:
            assert (r["n_shingles"], r["component_id"]) == (0, None)
        else:
            assert (r["n_shingles"], r["component_id"]) == want[r["doc_id"]], r


def test_jaccard_of_nothing(docs):
    assert jaccard_join.jaccard_components(docs.limit(0)).count() == 0


@pytest.mark.parametrize("n", [3, 10, 40, 63, 64, 90, 127, 128, 200, 250])
def test_linked_sets_share_a_block(n):
    """The pigeonhole holds where all blocks are joined."""
    rng = np.random.default_rng(n)
    for _ in range(20):
        m = int(rng.integers(n, math.floor(n / 0.75) + 1))
        inter = math.ceil(3 * (n + m) / 7)
        if inter > n:
            continue
        a = rng.integers(0, 2**63, n + m, dtype=np.int64).astype(np.uint64)
        x, y = np.sort(a[:n]), np.sort(np.concatenate([a[:inter], a[n : n + m - inter]]))
        shared = set(bands(len(x))) & set(bands(len(y)))
        assert shared and any(set(blocks(x, k).tolist()) & set(blocks(y, k).tolist()) for k in shared)


def test_components_equal_union_find(spark):
    r = random.Random(3)
    edges = [(r.randrange(300), r.randrange(300)) for _ in range(200)] + [(5000, k) for k in range(5001, 5200)] + [(k, k + 1) for k in range(7000, 7040)] + [(9, 9)]
    got = {x["id"]: x["component"] for x in components(Scratch(spark, "t"), spark.createDataFrame(edges, "a bigint, b bigint").repartition(5)).collect()}
    g = Groups({x for e in edges for x in e})
    for a, b in edges:
        if a != b:
            g.join(a, b)
    assert got == {x: g.find(x) for x in g.root if g.find(x) != x}


@pytest.mark.parametrize("probes,per_list", [(vector_links.PROBES, vector_links.LIST), (None, 8), (None, 1)])
def test_vectors_equal_brute_force(spark, monkeypatch, probes, per_list):
    monkeypatch.setattr(vector_links, "LIST", per_list)
    if per_list == 1:
        monkeypatch.setattr(vector_links, "levels", lambda n: (7, 5))
    rng = np.random.default_rng(1)
    rows = []
    for label in (0, 1, None):
        base = rng.normal(size=(30, 24))
        for k in range(120):
            v = base[k % 30] + rng.normal(size=24) * rng.choice([0.02, 0.15, 0.5])
            rows.append((len(rows), v.astype(np.float32).tolist(), label))
    for k in range(150):  # a hot group and exact copies
        rows.append((len(rows), (np.ones(24) + 0.01 * (k // 3)).astype(np.float32).tolist(), 1))
    rows += [(9000, None, 0), (9001, [0.0] * 24, 0), (9002, [float("nan")] + [1.0] * 23, 0), (9003, [None] + [1.0] * 23, 0), (9004, [float("inf")] + [1.0] * 23, 1), (9005, [], 0), (9006, [1.0] * 5, 1), (9007, [2.0] * 5, 1), (None, [1.0] * 24, 1)]
    d = spark.createDataFrame([(*r, 1) for r in rows], "vec_id bigint, embedding array<float>, label int, dim int").repartition(4)
    got = {r["vec_id"]: r for r in vector_links.near_vectors(d, probes=probes).collect()}
    good = [(i, np.array(v, float), y) for i, v, y in rows if i is not None and y is not None and v and None not in v and np.isfinite(v).all() and np.any(v)]
    g, links = Groups([r[0] for r in rows if r[0] is not None]), dict.fromkeys((r[0] for r in rows), 0)
    for k, (i, v, y) in enumerate(good):
        for j, w, z in good[k + 1 :]:
            if y == z and len(v) == len(w) and v @ w / np.sqrt((v @ v) * (w @ w)) >= 0.93:
                links[i] += 1
                links[j] += 1
                g.join(i, j)
    assert len(got) == len(rows)
    want = sum(links.values())
    assert want and sum(abs(links[i] - got[i]["n_links"]) for i in links) <= (0.02 * want if probes else 0)
    same = [got[i]["component_id"] == g.find(i) for i in g.root]
    assert np.mean(same) >= (0.98 if probes else 1) and got[None]["component_id"] is None
    assert all(got[i]["n_links"] == 0 and got[i]["kept"] for i in (9000, 9001, 9002, 9003, 9004, 9005))
    assert got[9006]["n_links"] == got[9007]["n_links"] == 1
    assert vector_links.near_vectors(d.limit(0)).count() == 0
    assert vector_links.near_vectors(d.filter("vec_id = 3")).select("n_links").first()[0] == 0


def test_links_count_copies(spark):
    d = spark.createDataFrame([(i, [1.0, float(i // 4) * 0.01], 0) for i in range(12)], "vec_id bigint, embedding array<float>, label int")
    got = vector_links.near_vectors(d).orderBy("vec_id").collect()
    assert [r["n_links"] for r in got] == [11] * 12 and [r["kept"] for r in got] == [True] + [False] * 11
    assert d.filter(F.col("vec_id") < 0).count() == 0


def test_doubles_are_not_narrowed(spark):
    near = [1.0, 0.3952355, 0.0]  # cosine just below 0.93 in double precision, not in single
    cos = near[0] / math.hypot(*near)
    near[1] *= 1 + (cos - 0.93 + 1e-9) * 20 if cos >= 0.93 else 1
    rows = [(1, [1e300, 0.0, 0.0], 0), (2, [1e300, 0.0, 0.0], 0), (3, [1e-300, 0.0, 0.0], 0), (4, near, 0), (5, [0.0, 0.0, 1.0], 0), (6, [0.0, 1e308, 1e308], 1), (7, [0.0, 1e308, 1e308], 1)]
    got = {r["vec_id"]: r for r in vector_links.near_vectors(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int")).collect()}
    want = int(near[0] / math.hypot(*near) >= 0.93)
    assert got[1]["n_links"] == got[2]["n_links"] == got[3]["n_links"] == 2 + want and got[4]["n_links"] == 3 * want
    assert got[5]["n_links"] == 0 and got[6]["n_links"] == got[7]["n_links"] == 1
