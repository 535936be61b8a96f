from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest

from stratawork.llm import suffix_repeats as S
from tests.llm.conftest import prose


def brute(rows, length=100):
    """By a dictionary of all windows, documents in the order of (id, digest)."""
    seen, out = set(), []
    data = [((t or "").encode(), i) for i, t in rows]
    for b, i in sorted(data, key=lambda x: (x[1] is not None, x[1] or 0, hashlib.sha256(x[0]).hexdigest())):
        gone = np.zeros(len(b), bool)
        for p in range(len(b) - length + 1):
            if b[p : p + length] in seen:
                gone[p : p + length] = True
            seen.add(b[p : p + length])
        kept = bytes(np.frombuffer(b, np.uint8)[~gone])
        edges = np.diff(np.concatenate([[0], gone.astype(int)]))
        out.append((i, len(b), int(gone.sum()), int((edges == 1).sum()), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def corpus():
    r = random.Random(5)
    rows = [(k, prose(k, 40 + k)) for k in range(12)]
    passage, line = prose(90, 40), "a common line that stands in most documents, word for word and again and again, of over a hundred bytes\n"
    rows += [(20 + k, prose(50 + k, 30) + passage + prose(70 + k, 5 * k)) for k in range(8)]
    rows += [(40 + k, line + prose(200 + k, 12) + "\n" + line[: 95 + k]) for k in range(20)]
    base = prose(300, 200)
    rows += [(60, base), (61, base), (62, base[:400] + "X" + base[401:]), (63, base[3:]), (64, base[-150:] + base[:150]), (65, passage[:99]), (66, passage[:100]), (67, passage[:101])]
    rows += [(70, "ab" * 400), (71, "ba" * 300), (72, "a" * 99), (73, "b" * 100), (74, "b" * 350), (75, "é" * 120), (76, "xé" * 80), (77, "é" * 50), (78, None), (79, ""), (80, "".join(r.choice("ab") for _ in range(3000)))]
    rows += [(81, passage + passage), (82, (passage + ".") * 5)]
    return rows


SCHEMA = "doc_id bigint, text string, doc int, s int, g string, lo int"


def run(spark, rows, **limits):
    docs = spark.createDataFrame([(*r, 1, 2, "x", 3) for r in rows], SCHEMA).repartition(4)
    return sorted((tuple(r) for r in S.keep_first(docs, **limits).collect()), key=str)


@pytest.mark.parametrize("limits", [{}, {"hot": 2, "most": 3, "cell": 5, "held": 40}, {"most": 0, "held": 10}])
def test_brute_force(spark, limits):
    """Production parameters; hot buckets by aggregates, small cells, few contexts held; all windows by aggregates."""
    rows = corpus()
    assert run(spark, rows, **limits) == brute(rows)


def test_null_and_repeated_ids(spark):
    base, other = prose(1, 80), prose(2, 80)
    rows = [(5, base), (5, base), (5, other + base), (None, other), (None, base[:200]), (7, other), (5, None), (8, "short")]
    assert run(spark, rows) == brute(rows)
    assert run(spark, []) == []
    assert run(spark, [(1, None), (2, "")]) == brute([(1, None), (2, "")])


def test_long_text(spark):
    """A text of several blocks, and a window that crosses the edge of one."""
    big = prose(9, 30_000)
    rows = [(2, big), (1, big[50_000:50_400]), (3, big[100:] + "tail")]
    assert run(spark, rows) == brute(rows)


def test_anchors_and_blocks():
    rng = np.random.default_rng(3)
    data = rng.integers(97, 100, 4000).astype(np.uint8)
    at, h = S.anchors(data, 100, 32), S.rolling(data, 32, np.uint32, S._M32)
    assert all(a == p + int(np.argmin(h[p : p + 69])) for p, a in enumerate(at))
    ends = np.array([0, 50, 149, 149, 249, 1500, 1599, 4000])
    whole = [np.concatenate(x) for x in zip(*S.contexts(data, ends, 100, 32, 1 << 20), strict=True)]
    for block in (200, 333, 1024):
        parts = [np.concatenate(x) for x in zip(*S.contexts(data, ends, 100, 32, block), strict=True)]
        assert all((a == b).all() for a, b in zip(whole, parts, strict=True))
    starts = np.concatenate([[0], ends[:-1]])
    covered = sorted(p for lo, n in zip(whole[1], whole[2], strict=True) for p in range(lo, lo + n))
    assert covered == [p for s, e in zip(starts, ends, strict=True) for p in range(s, max(s, e - 99))]


def test_refinement():
    """Final buckets are those of equal windows, and alone are those that no other equals."""
    rng = np.random.default_rng(4)
    part = rng.integers(97, 99, 300).astype(np.uint8)
    data = np.concatenate([part, rng.integers(97, 99, 200).astype(np.uint8), part[50:250], part[:150]])
    at = np.concatenate([np.arange(0, 401), np.arange(500, 601), np.arange(700, 751)])
    alive, bucket = S.refined(data, at, 100)
    text = [data[p : p + 100].tobytes() for p in at]
    assert sorted(alive.tolist()) == [k for k, x in enumerate(text) if text.count(x) > 1]
    assert len({(b, text[k]) for k, b in zip(alive.tolist(), bucket.tolist(), strict=True)}) == len(set(bucket.tolist())) == len({text[k] for k in alive})
    clash = np.zeros(len(alive), np.int64)
    assert len(set(S._exact(data, at[alive], clash, 100).tolist())) == len(set(bucket.tolist()))
