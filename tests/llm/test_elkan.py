from __future__ import annotations

import hashlib

import numpy as np
import pytest

from stratawork.llm import elkan


def brute(rows, k=40, rounds=5, seed=2):
    """All distances in every round, in whole numbers."""
    vs = [(i, np.array([int(np.floor(256 * np.float64(x))) for x in v], object)) for i, v in rows if v is not None and len(v) == 64 and all(x is not None and np.isfinite(x) for x in v)]
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    cs = [v for _, v in sorted(((sha(f"{seed}:{i}"), v) for i, v in vs if i is not None), key=lambda x: (x[0], list(x[1])))[:k]]
    if not cs:
        return []
    near = lambda v: min(((int(((v - c) ** 2).sum()), n) for n, c in enumerate(cs)))
    for _ in range(rounds):
        at = [near(v)[1] for _, v in vs]
        for n in set(at):
            own = [v for (_, v), a in zip(vs, at, strict=True) if a == n]
            cs[n] = np.array([sum(x) // len(own) for x in zip(*own, strict=True)], object)
    last = [(i, *near(v)[::-1]) for i, v in vs]
    part = {n: sum(d for _, m, d in last if m == n) for _, n, _ in last}
    return sorted(((i, n, d, part[n], sum(part.values()), sha(",".join(map(str, cs[n])))) for i, n, d in last), key=str)


def vectors(seed, n, spread=0.05):
    rng = np.random.default_rng(seed)
    centre = rng.normal(size=(6, 64))
    return [(k, [float(x) for x in (centre[k % 6] + spread * rng.normal(size=64))]) for k in range(n)]


SCHEMA = "vec_id bigint, embedding array<double>, id int, q string, at int, cluster string"


def run(spark, rows, **args):
    df = spark.createDataFrame([(*r, 1, "x", 2, "y") for r in rows], SCHEMA).repartition(3)
    return sorted((tuple(r) for r in elkan.cluster(df, **args).collect()), key=str)


def test_brute_force(spark):
    """Blobs, repeated vectors and ids, ties, and rows that are left out."""
    rows = vectors(1, 150) + vectors(2, 60, 2.0)[:60]
    rows = [(k, v) for k, (_, v) in enumerate(rows)]
    rows += [(3, rows[3][1]), (3, rows[8][1]), (500, rows[3][1]), (None, rows[5][1]), (501, [0.0] * 64), (502, [-1 / 512] * 64), (503, None), (504, [0.5] * 63), (505, [None] + [0.5] * 63), (506, [float("nan")] * 64), (507, [float("inf")] + [0.0] * 63), (508, [900.0, -900.0] * 32)]
    assert run(spark, rows) == brute(rows)


@pytest.mark.parametrize("rows", [[], [(1, None)], [(None, [0.5] * 64)], [(k, [0.25] * 64) for k in range(60)], [(k, [0.25 * (k % 3)] * 64) for k in range(5)]])
def test_few_and_equal(spark, rows):
    """None; no id; all equal, which ties everywhere and leaves clusters empty; fewer vectors than centroids."""
    assert run(spark, rows) == brute(rows)


def test_ties_go_to_the_smaller_number(spark):
    """Vectors on a grid, many of which are as far from one centroid as from another."""
    rng = np.random.default_rng(5)
    rows = [(k, [float(x) / 256 for x in rng.integers(-1, 2, 64) * 2]) for k in range(200)]
    assert run(spark, rows, k=7) == brute(rows, k=7)


def test_bounds_skip_and_hold():
    """Far fewer distances than all, and bounds that enclose the truth after every round."""
    rng = np.random.default_rng(6)
    blobs = rng.integers(-500, 500, (12, 64))
    x = blobs[rng.integers(0, 12, 2000)] + rng.integers(-20, 21, (2000, 64))
    now, at, upper, lower, before, spent = x[:20].copy(), None, None, None, None, []
    for _ in range(6):
        at, upper, lower, done = elkan.assign(x, at, upper, lower, elkan.Centres(now, before))
        d2 = np.stack([((x - c) ** 2).sum(1) for c in now], axis=1)
        assert (at == d2.argmin(1)).all()
        true = np.sqrt(d2.astype(np.longdouble))
        assert (upper >= true[np.arange(len(x)), at]).all() and (lower <= true).all()
        spent.append(done)
        before = now
        now = np.array([np.floor_divide(x[at == c].sum(0), (at == c).sum()) if (at == c).any() else now[c] for c in range(20)])
    assert spent[0] < 20 * 2000 and sum(spent[1:]) < 0.5 * 5 * 20 * 2000


def test_costs(spark):
    rows, costs = vectors(7, 300), []
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    elkan.cluster(df, costs=costs).count()
    assert len(costs) == 6 and sum(costs) < 6 * 300 * 40
