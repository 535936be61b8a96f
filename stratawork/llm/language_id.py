"""Language identification by prediction by partial matching over byte contexts."""

from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratawork.llm.shingles import column_bytes
from stratawork.llm.support import prepare, slim

ORDER = 4
#: Bound of the sample that the trees are grown from: documents a language, characters of each and bytes of all at most; arguments of ``train``, None lifts them.
SAMPLE_DOCS, SAMPLE_DOC_BYTES, SAMPLE_BYTES = 700, 1 << 16, 1 << 22
#: Context nodes at most, and bytes of the table of code lengths at most; None lifts them.
NODES, TABLE_BYTES = 1 << 14, 40 << 20
STRETCH = 1 << 18


def has_letter(text: str | None) -> bool:
    """Whether a text holds a character of a letter category; numerals such as fractions are none."""
    return bool(text) and any(map(str.isalpha, text))


class Trees:
    """Per-language context trees with frozen statistics, joined into one automaton.

    Nodes are byte contexts up to ORDER long. In language l, a symbol seen c
    times in a context of T symbols, d of them distinct, has probability
    c / (T + d); one not seen escapes with d / (T + d) to the next shorter
    context, below the empty one to a uniform choice. A context that a
    language has not seen costs nothing to leave. As nothing is updated, the
    exact code length is a function of (deepest known context, symbol), which
    is worked out once into ``cost``.
    """

    def __init__(self, texts: dict[str, list[bytes]], counts: dict[str, int], order: int = ORDER, nodes: int | None = NODES, table: int | None = TABLE_BYTES):
        self.langs, self.order = sorted(texts), order
        streams = [np.frombuffer(b"".join(b"\n" * order + t for t in texts[k]), np.uint8) for k in self.langs]
        seen = np.unique(np.concatenate([*streams, np.frombuffer(b"\n", np.uint8)]))
        self.symbol = np.full(256, len(seen), np.uint8)  # the last symbol stands for bytes that were never seen
        self.symbol[seen] = np.arange(len(seen))
        a = self.size = len(seen) + 1
        total = sum(counts.values())
        self.prior = np.array([-np.log2(counts[k] / total) for k in self.langs])
        coded = [self.symbol[s].astype(np.int64) for s in streams]
        limit = max(a + 1, min(nodes or 1 << 40, (table or 1 << 60) // (4 * a * len(self.langs))))
        # contexts by their number of occurrences, each after its suffix; codes read backwards from the symbol
        parent, last, depth = [0], [0], [0]
        known = [{0: 0}]
        for k in range(1, order + 1):
            found: dict[int, int] = {}
            for s in coded:
                keys, n = np.unique(self._context(s, k), return_counts=True)
                for key, c in zip(keys.tolist(), n.tolist(), strict=True):
                    found[key] = found.get(key, 0) + c
            level: dict[int, int] = {}
            most = limit - len(parent) if k == order else (limit - len(parent)) // 2 if k > 1 else a
            best = sorted((-c, key) for key, c in found.items() if c >= 4 and key // a in known[k - 1])[: max(0, most)]
            for _, key in best:
                level[key] = len(parent)
                parent.append(known[k - 1][key // a])
                last.append(key % a)
                depth.append(k)
            known.append(level)
        n = len(parent)
        self.child = np.full(n * a, -1, np.int32)
        for node in range(1, n):
            self.child[parent[node] * a + last[node]] = node
        self.cost = np.zeros((n, a, len(self.langs)), np.float32)
        up = np.array(parent)
        for j, s in enumerate(coded):
            node = self._deepest(s)
            c = np.zeros((n, a))
            np.add.at(c, (node[order:], s[order:]), 1)
            for k in range(order, 0, -1):  # a context has the counts of those that extend it
                own = np.flatnonzero(np.array(depth) == k)
                np.add.at(c, up[own], c[own])
            t, d = c.sum(1), (c > 0).sum(1)
            with np.errstate(divide="ignore", invalid="ignore"):
                hit = np.log2(t + d)[:, None] - np.log2(c)
                leave = np.log2(t + d) - np.log2(d)
            for k in range(order + 1):
                for node_ in np.flatnonzero(np.array(depth) == k):
                    below = self.cost[up[node_], :, j] if node_ else np.full(a, np.log2(a))
                    self.cost[node_, :, j] = below if not t[node_] else np.where(c[node_] > 0, hit[node_], leave[node_] + below)
        self.cost = self.cost.reshape(n * a, len(self.langs))

    def _context(self, s: np.ndarray, k: int) -> np.ndarray:
        """Codes of the k symbols before each place from ``order`` on, nearest first."""
        out = np.zeros(max(0, len(s) - self.order), np.int64)
        for i in range(1, k + 1):
            out = out * self.size + s[self.order - i : len(s) - i]
        return out

    def _deepest(self, s: np.ndarray) -> np.ndarray:
        """The node of the longest known context before each place; 0 for the first ``order``."""
        node = np.zeros(len(s), np.int32)
        at = np.arange(self.order, len(s))
        for i in range(1, self.order + 1):
            step = self.child[node[at] * self.size + s[at - i]]
            ok = step >= 0
            at = at[ok]
            node[at] = step[ok]
        return node

    def bits(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Exact code lengths (texts x languages) of texts that lie end to end in ``data``."""
        out = np.zeros((len(offsets) - 1, len(self.langs)))
        pad = np.full(self.order, self.symbol[10], np.int64)
        i, n = 0, len(offsets) - 1
        while i < n:
            j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + STRETCH, "right")) - 1)
            if j == i + 1 and offsets[j] - offsets[i] > STRETCH:  # a long text: stretches that carry their context on
                before = pad
                for at in range(int(offsets[i]), int(offsets[j]), STRETCH):
                    s = np.concatenate([before, self.symbol[data[at : min(int(offsets[j]), at + STRETCH)]].astype(np.int64)])
                    out[i] += self.cost[self._deepest(s).astype(np.int64) * self.size + s][self.order :].sum(0, dtype=np.float64)
                    before = s[-self.order :]
            else:
                sizes = np.diff(offsets[i : j + 1])
                s = np.full(int(offsets[j] - offsets[i]) + self.order * (j - i), pad[0], np.int64)
                first = offsets[i:j] - offsets[i] + self.order * np.arange(1, j - i + 1)
                k = np.arange(int(offsets[j] - offsets[i])) + np.repeat(self.order * np.arange(1, j - i + 1), sizes)
                s[k] = self.symbol[data[offsets[i] : offsets[j]]]
                c = self.cost[(self._deepest(s).astype(np.int64) * self.size + s)[k]]
                some = np.flatnonzero(sizes > 0)
                if len(some):
                    out[i + some] = np.add.reduceat(c, (first - self.order * np.arange(1, j - i + 1))[some], axis=0, dtype=np.float64)
            i = j
        return out


def held_out(id_col: Column, parts: int, part: int) -> Column:
    """Whether the checksum of the id's text leaves ``part``; of a null id it does not."""
    return F.coalesce(F.pmod(F.crc32(id_col.cast("string").cast("binary")), F.lit(parts)) == part, F.lit(False))


def train(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", docs: int | None = SAMPLE_DOCS, chars: int | None = SAMPLE_DOC_BYTES, size: int | None = SAMPLE_BYTES, nodes: int | None = NODES, table: int | None = TABLE_BYTES
) -> Trees | None:
    """Trees from a bounded sample of the rows with a text and a language; None if there are none.

    Languages are counted over all rows, which makes the prior. Of each the
    ``docs`` rows of the smallest hashes of (id, text) are learned, rows that
    repeat both once, as far as their first ``size`` bytes go; so neither null
    nor repeated ids crowd out others, and a language of few rows is learned
    from all of them. A longer text teaches with its first ``chars``
    characters, so a language of long texts alone is known. ``nodes`` and
    ``table`` bound the trees; None lifts a bound, and without any the trees
    hold every context of every row.
    """
    rows = slim(df, id=id_col, text=text_col, lang=lang_col).filter(F.col("text").isNotNull() & F.col("lang").isNotNull() & (F.col("text") != ""))
    rows = rows.withColumn("h", F.xxhash64("id", "text"))
    known = {r["lang"]: (r["n"], r["d"]) for r in rows.groupBy("lang").agg(F.count("*").alias("n"), F.approx_count_distinct("h", 0.02).alias("d")).collect()}  # a row a language
    if not known:
        return None
    picked = rows
    if docs is not None:  # a tenth more than wanted, as the count is not exact; what is too much goes below
        share = F.create_map(*(F.lit(x) for k, (_, d) in sorted(known.items()) for x in (k, 1 << 30 if d <= 2 * docs else int((1.1 * docs + 30) / d * (1 << 30)))))
        picked = rows.filter(F.pmod("h", F.lit(1 << 30)) < share[F.col("lang")])
    picked = picked.select("lang", "h", F.pmod("h", F.lit(1 << 30)).alias("p"), F.left("text", F.lit(chars)).alias("text") if chars else "text").dropDuplicates(["lang", "h"]).toArrow().sort_by([("p", "ascending"), ("h", "ascending")])
    texts: dict[str, list[bytes]] = {}
    held: dict[str, int] = {}
    for lang, text in zip(picked.column("lang").to_pylist(), picked.column("text").to_pylist(), strict=True):
        data, have = text.encode(), texts.setdefault(lang, [])
        if (docs is None or len(have) < docs) and (not have or size is None or held[lang] + len(data) <= size):
            have.append(data)
            held[lang] = held.get(lang, 0) + len(data)
    return Trees(texts, {k: known[k][0] for k in texts}, nodes=nodes, table=table)


def predict(df: DataFrame, trees: Trees | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, lang_pred, score) from the whole text of every row: the language with the shortest code, prior included.

    score is its posterior probability. A text that is null or has no letter,
    and any text if nothing was learned, is ``und`` with score 0. The trees,
    whose size is bounded, go out with the task; one narrow pass.
    """
    prepare(df.sparkSession)
    kept = df.sparkSession.sparkContext.broadcast(None if trees is None else zlib.compress(_dump(trees), 1))

    def run(batches):
        import pyarrow as pa

        model = _load(kept.value)
        for b in batches:
            texts = b.column(1).to_pylist()
            letter = [has_letter(t) for t in texts]
            if model is None:
                pred, score = ["und"] * len(texts), [0.0] * len(texts)
            else:
                bits = model.bits(*column_bytes(b.column(1))) + model.prior
                best = bits.argmin(1)
                odds = 1 / np.exp2(np.maximum(-1000, bits.min(1, keepdims=True) - bits)).sum(1)
                pred = [model.langs[k] if ok else "und" for k, ok in zip(best.tolist(), letter, strict=True)]
                score = [p if ok else 0.0 for p, ok in zip(odds.tolist(), letter, strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(pred, pa.string()), pa.array(score, pa.float64())], names=["id", "lang_pred", "score"])

    kind = df.schema[id_col].dataType.simpleString()
    return slim(df, id=id_col, text=text_col).mapInArrow(run, f"id {kind}, lang_pred string, score double").withColumnRenamed("id", id_col)


def _dump(t: Trees) -> bytes:
    import pickle

    return pickle.dumps((t.langs, t.order, t.symbol, t.size, t.prior, t.child, t.cost))


_models: dict[int, Trees] = {}


def _load(data: bytes | None) -> Trees | None:
    """One model a worker process, found by what the broadcast holds."""
    import pickle

    if data is None:
        return None
    key = zlib.crc32(data)
    if key not in _models:
        _models.clear()
        t = Trees.__new__(Trees)
        t.langs, t.order, t.symbol, t.size, t.prior, t.child, t.cost = pickle.loads(zlib.decompress(data))
        _models[key] = t
    return _models[key]
