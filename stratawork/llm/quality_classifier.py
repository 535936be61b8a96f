"""Quality classifier: a sparse ensemble of conjunctive rules over text statistics, compiled into Spark columns."""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratawork.llm.quality_rules import measures, only, settled
from stratawork.llm.support import prepare

STATISTICS = ("n_words", "mean_word_length", "symbols_per_word", "stop_word_ratio", "letter_ratio", "upper_ratio", "dup_line_ratio", "repeat_word_ratio")
#: Labelled documents that the model is fitted on at most (about: a hash picks them).
SAMPLE = 4000
TREES, DEPTH, LEAF = 40, 3, 8


class Condition(NamedTuple):
    statistic: int
    above: bool
    value: float


def _split(x: np.ndarray, y: np.ndarray, features: np.ndarray) -> tuple[int, float] | None:
    """The cut that lowers the squared error most."""
    best, gain = None, 1e-9
    n, total = len(y), y.sum()
    for f in features:
        order = np.argsort(x[:, f], kind="stable")
        v, s = x[order, f], np.cumsum(y[order])
        k = np.arange(1, n)
        ok = (v[1:] > v[:-1]) & (k >= LEAF) & (n - k >= LEAF)
        if not ok.any():
            continue
        left = s[:-1]
        g = np.where(ok, left**2 / k + (total - left) ** 2 / (n - k) - total**2 / n, -1)
        i = int(g.argmax())
        if g[i] > gain:
            best, gain = (int(f), float((v[i] + v[i + 1]) / 2)), g[i]
    return best


def _paths(x: np.ndarray, y: np.ndarray, depth: int, rng: np.random.Generator, path: tuple[Condition, ...] = ()) -> list[tuple[Condition, ...]]:
    """The paths to all nodes of a tree, inner ones too."""
    out = [path] if path else []
    features = rng.permutation(x.shape[1])[: max(2, x.shape[1] // 2)]
    if depth and len(y) >= 2 * LEAF and (cut := _split(x, y, features)):
        f, v = cut
        above = x[:, f] > v
        out += _paths(x[above], y[above], depth - 1, rng, (*path, Condition(f, True, v)))
        out += _paths(x[~above], y[~above], depth - 1, rng, (*path, Condition(f, False, v)))
    return out


def _holds(rule: tuple[Condition, ...], x: np.ndarray) -> np.ndarray:
    ok = np.ones(len(x), bool)
    for c in rule:
        ok &= (x[:, c.statistic] > c.value) == c.above
    return ok


class RuleModel(NamedTuple):
    """A logistic score: the bias and each rule's weight where the rule holds."""

    bias: float
    rules: tuple[tuple[float, tuple[Condition, ...]], ...]

    def margins(self, x: np.ndarray) -> np.ndarray:
        return self.bias + sum((w * _holds(r, x) for w, r in self.rules), np.zeros(len(x)))

    def column(self) -> Column:
        """The score as one column expression over STATISTICS."""
        margin = F.lit(float(self.bias))
        for w, rule in self.rules:
            ok = F.lit(True)
            for c in rule:
                v = F.col(STATISTICS[c.statistic])
                ok = ok & (v > F.lit(c.value) if c.above else v <= F.lit(c.value))
            margin = margin + F.when(ok, F.lit(float(w))).otherwise(F.lit(0.0))
        return 1 / (1 + F.exp(-margin))


def lasso_logistic(r: np.ndarray, y: np.ndarray, penalty: float, steps: int = 400) -> tuple[float, np.ndarray]:
    """(bias, weights) that minimise the mean logistic loss plus penalty * |weights|, by accelerated proximal gradient."""
    n, k = r.shape
    mean = min(max(y.mean(), 1e-3), 1 - 1e-3)
    b, w = float(np.log(mean / (1 - mean))), np.zeros(k)
    rate = 4 / max(1e-9, np.linalg.norm(np.column_stack([r, np.ones(n)]), 2) ** 2 / n)
    vb, vw, t = b, w, 1.0
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(r @ vw + vb, -40, 40)))
        e = (p - y) / n
        nb, nw = vb - rate * e.sum(), vw - rate * (r.T @ e)
        nw = np.sign(nw) * np.maximum(0, np.abs(nw) - rate * penalty)
        t2 = (1 + (1 + 4 * t * t) ** 0.5) / 2
        vb, vw = nb + (t - 1) / t2 * (nb - b), nw + (t - 1) / t2 * (nw - w)
        b, w, t = float(nb), nw, t2
    return b, w


def fit(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH, penalty: float = 1e-3, seed: int = 3) -> RuleModel:
    """Boosted small trees give the rules, the lasso keeps few of them. One class alone, or no rows, is a constant score."""
    if not len(y):
        return RuleModel(0.0, ())
    mean = float(np.clip(y.mean(), 0.01, 0.99))
    if y.min() == y.max():
        return RuleModel(float(np.log(mean / (1 - mean))), ())
    rng = np.random.default_rng(seed)
    rules: dict[tuple[Condition, ...], None] = {}
    margin = np.full(len(y), np.log(mean / (1 - mean)))
    for _ in range(trees):
        rest = y - 1 / (1 + np.exp(-margin))
        take = rng.random(len(y)) < 0.7
        paths = _paths(x[take], rest[take], depth, rng)
        for p in paths:
            rules.setdefault(tuple(sorted(p)))
        ends = [p for p in paths if not any(q[: len(p)] == p and len(q) > len(p) for q in paths)]
        for p in ends:
            ok = _holds(p, x)
            if ok.any():
                margin[ok] += 2.0 * rest[ok].mean()
    found = list(rules)
    r = np.column_stack([_holds(p, x) for p in found]).astype(float) if found else np.zeros((len(y), 0))
    _, unique = np.unique(r, axis=1, return_index=True)
    keep = sorted(unique.tolist())
    bias, w = lasso_logistic(r[:, keep], y.astype(float), penalty)
    return RuleModel(bias, tuple((float(w[i]), found[k]) for i, k in enumerate(keep) if abs(w[i]) > 1e-6))


def train(docs: DataFrame, labels: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", sample: int = SAMPLE) -> RuleModel:
    """A model from about ``sample`` labelled ids for which ``learn`` (over id_col of labels) holds, picked by a hash of the id.

    Labels other than 0 and 1, and those without an id, do not count. An id
    with both labels counts with each, a label that is repeated once; of
    documents that repeat an id the one of the smallest text hash teaches, so
    no id brings more than two rows. Null and very long texts teach like
    others. Only the statistics of the sample come to the driver.
    """
    prepare(docs.sparkSession)
    known = labels.filter(learn & F.col(f"`{label_col}`").isin(0, 1)).select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{label_col}`").alias("y")).filter("id is not null").distinct()
    n = known.count()
    if not n:
        return fit(np.zeros((0, len(STATISTICS))), np.zeros(0))
    picked = known.filter(F.pmod(F.xxhash64("id", F.lit(11)), F.lit(1 << 30)) < int(min(1.0, sample / n) * (1 << 30)))
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text")).join(F.broadcast(picked), "id")
    rows = rows.groupBy("id", "y").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    got = measures(rows, ["id", "y"], "text").select(F.col("c0").alias("id"), F.col("c1").alias("y"), *STATISTICS).toArrow().sort_by([("id", "ascending"), ("y", "ascending"), *((s, "ascending") for s in STATISTICS)])
    x = np.column_stack([np.array(got.column(s).to_pylist(), float) for s in STATISTICS]) if got.num_rows else np.zeros((0, len(STATISTICS)))
    return fit(x, np.array(got.column("y").to_pylist(), float))


def score(df: DataFrame, model: RuleModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score, predicted) of every row from its whole text alone; null and empty texts are scored as empty.

    Statistics and rules are column expressions: one narrow projection.
    """
    s = settled(measures(df, [id_col], text_col), ["c0"], [model.column().alias("score")])
    return s.select(F.col("c0").alias(id_col), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def good_documents(df: DataFrame, model: RuleModel, text_col: str = "text", least: float = 0.5) -> DataFrame:
    """The documents with a score of ``least`` or more, with all their columns, in one narrow pass."""
    own = [f"c{i}" for i in range(len(df.columns))]
    return only(settled(measures(df, df.columns, text_col), own, [model.column().alias("score")]), df.columns, F.col("score") >= least)
