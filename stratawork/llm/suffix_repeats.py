"""Repeated passages by bucket-pointer refinement of suffixes, at content-defined places.

A byte goes if it is in a string of LENGTH bytes (a window) that also starts
earlier: in a document of a smaller id or earlier in the same. Each window is
governed by the place of its least q-gram, its anchor, so equal windows have
equal anchors at equal offsets. A run of windows with one anchor is a context.

* Initial buckets: contexts by the q-gram at their anchor. What is alone in
  its bucket repeats nothing and is done.
* Equal contexts of a bucket repeat the first of them, windows and all.
* Different contexts of one bucket are refined window by window: buckets of a
  quarter of a window are sorted on the bucket pointers of the next quarter,
  and the halves that this gives on the pointers of the half behind them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stratawork.llm.support import Scratch, slim
from stratawork.operators.windows import numbered

#: Bytes of a window and of a q-gram.
LENGTH, GRAM = 100, 32
#: Contexts that a task holds before it sends on the first of equal ones; contexts in a cell, about, and of one bucket in a cell at most.
HELD, CELL, MOST = 1 << 18, 4096, 1 << 14
#: A bucket that holds more rows than this and than one in 65,536 of all is never brought together; one row in 64 is looked at to find such.
HOT, SHARE, LOOK = 1 << 16, 1 << 16, 64
_BLOCK = 1 << 15
_M32, _M64 = 0x9E3779B1, 0x9E3779B97F4A7C15


def rolling(data: np.ndarray, size: int, kind: type, factor: int) -> np.ndarray:
    """A polynomial hash of the ``size`` bytes at each place, by doubling."""
    mod = 1 << np.dtype(kind).itemsize * 8
    cur, width, out, have = data.astype(kind) + kind(1), 1, None, 0
    while True:
        if size & width:
            out, have = (cur, width) if out is None else (out[: len(out) - width] * kind(pow(factor, width, mod)) + cur[have : have + len(out) - width], have + width)
        if width * 2 > size:
            break
        cur = cur[:-width] * kind(pow(factor, width, mod)) + cur[width:]
        width *= 2
    out = out.copy()
    out ^= out >> kind(np.dtype(kind).itemsize * 4 - 1)
    out *= kind(0xD6E8FEB86659FD93 % mod)
    out ^= out >> kind(np.dtype(kind).itemsize * 4 + 1)
    return out


def anchors(data: np.ndarray, length: int, gram: int) -> np.ndarray:
    """For each window the place of its least q-gram by hash, the leftmost of equals."""
    h = rolling(data, gram, np.uint32, _M32)
    key = (h.astype(np.uint64) << np.uint64(32)) | np.arange(len(h), dtype=np.uint64)
    width, want = 1, length - gram + 1
    while width * 2 <= want:
        key = np.minimum(key[:-width], key[width:])
        width *= 2
    if want > width:
        key = np.minimum(key[: len(key) - (want - width)], key[want - width :])
    return (key & np.uint64(0xFFFFFFFF)).astype(np.int64)


def contexts(data: np.ndarray, ends: np.ndarray, length: int, gram: int, block: int = _BLOCK) -> Iterator[tuple[np.ndarray, ...]]:
    """(document, first window, windows, anchor) of each context in texts that lie one after the other and end at ``ends``; places are in ``data``."""
    total, s = len(data) - length + 1, 0
    starts = np.concatenate([[0], ends[:-1]])
    while s < total:
        e = min(total, s + block)
        at = anchors(data[s : e + length - 1], length, gram)
        new = np.ones(e - s, bool)
        new[1:] = at[1:] != at[:-1]
        for cut in (starts, ends - length + 1):
            a, b = np.searchsorted(cut, [s, e]) if cut is starts else (0, len(cut))
            inside = cut[a:b]
            new[inside[(inside >= s) & (inside < e)] - s] = True
        lo = np.flatnonzero(new)
        n = np.diff(np.concatenate([lo, [e - s]]))
        at, lo = at[lo] + s, lo + s
        nxt = e
        if e < total and len(lo) > 1:  # the last may go on in the next block
            nxt, lo, n, at = lo[-1], lo[:-1], n[:-1], at[:-1]
        doc = np.searchsorted(ends, lo, side="right")
        ok = lo + length <= ends[doc]
        yield doc[ok], lo[ok], n[ok], at[ok]
        s = nxt


def gram_ids(data: np.ndarray, at: np.ndarray, gram: int) -> np.ndarray:
    """A 64-bit name of the q-gram (a multiple of 8 bytes) at each place."""
    words = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(data, gram)[at]).view(np.uint64)
    x = np.full(len(at), _M64, np.uint64)
    for k in range(words.shape[1]):
        x = (x ^ words[:, k]) * np.uint64(0xD6E8FEB86659FD93)
        x ^= x >> np.uint64(29)
    return x.view(np.int64)


def laid_out(column) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of an Arrow column of texts, nulls empty, and the end of each."""
    import pyarrow as pa
    import pyarrow.compute as pc

    c = pc.fill_null(column, "" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    c = c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c
    c = c.cast(pa.large_binary())
    offsets = np.frombuffer(c.buffers()[1], np.int64)[c.offset : c.offset + len(c) + 1]
    body = c.buffers()[2]
    data = np.frombuffer(body, np.uint8)[offsets[0] : offsets[-1]] if body is not None and len(body) else np.zeros(0, np.uint8)
    return data, offsets[1:] - offsets[0]


def _named(docs: DataFrame, length: int, gram: int, held: int) -> DataFrame:
    """(g, c, doc, lo, n): contexts under the name of their q-gram and of their bytes; g is null for those that repeat an earlier one of the same task."""

    def run(batches):
        import pyarrow as pa

        rows: list[tuple[np.ndarray, ...]] = []

        def flush():
            g, c, doc, lo, n = (np.concatenate(x) for x in zip(*rows, strict=True))
            rows.clear()
            order = np.lexsort((lo, doc, c, g))
            g, c, doc, lo, n = (x[order] for x in (g, c, doc, lo, n))
            again = np.concatenate([[False], (g[1:] == g[:-1]) & (c[1:] == c[:-1])])
            return pa.RecordBatch.from_arrays([pa.array(g, mask=again), pa.array(c, mask=again), pa.array(doc), pa.array(lo), pa.array(n.astype(np.int32))], names=["g", "c", "doc", "lo", "n"])

        for b in batches:
            keys = np.asarray(b.column("doc"))
            data, ends = laid_out(b.column("text"))
            body, starts = memoryview(data), np.concatenate([[0], ends[:-1]]) if len(ends) else ends
            for doc, lo, n, at in contexts(data, ends, length, gram):
                names = b"".join([hashlib.blake2b(body[s:e], digest_size=8).digest() for s, e in zip(lo.tolist(), (lo + n + length - 1).tolist(), strict=True)])
                rows.append((gram_ids(data, at, gram), np.frombuffer(names, np.int64), keys[doc], lo - starts[doc], n))
                if sum(len(x[0]) for x in rows) >= held:
                    yield flush()
        if rows:
            yield flush()

    return docs.mapInArrow(run, "g bigint, c bigint, doc bigint, lo bigint, n int")


def _ranks(*keys: np.ndarray) -> np.ndarray:
    """Bucket pointers: the rank of each entry's sorted keys."""
    key = keys[0] if len(keys) == 1 else (keys[0].astype(np.uint64) << np.uint64(32)) | keys[1].astype(np.uint64)
    return np.unique(key, return_inverse=True)[1].astype(np.int64)


def _shared(bucket: np.ndarray) -> np.ndarray:
    return np.bincount(bucket)[bucket] > 1


def refined(data: np.ndarray, at: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Of the windows at ``at`` those that another equals, as places in ``at``, and their final buckets."""
    quarter, half = length // 4, length // 2
    first = rolling(data, quarter, np.uint64, _M64)
    pointer = _ranks(first)
    alive = np.flatnonzero(_shared(pointer[at]))
    for offset in (quarter, half):  # what is behind an entry has been refined to the depth that it has itself
        need = np.unique(np.concatenate([at[alive], at[alive] + half])) if offset == quarter else at[alive]
        deeper = np.zeros(len(data), np.int64)
        deeper[need] = _ranks(pointer[need], pointer[need + offset])
        pointer = deeper
        alive = alive[_shared(pointer[at[alive]])] if len(alive) else alive
    return alive, pointer[at[alive]]


def _exact(data: np.ndarray, at: np.ndarray, bucket: np.ndarray, length: int) -> np.ndarray:
    """``bucket``, after a look at the bytes of all that share one; if names have ever clashed, buckets by bytes."""
    view = np.lib.stride_tricks.sliding_window_view(data, length)
    model = np.zeros(bucket.max(initial=0) + 1, np.int64)
    model[bucket] = at
    for k in range(0, len(at), 1 << 15):
        if (view[at[k : k + (1 << 15)]] != view[model[bucket[k : k + (1 << 15)]]]).any():
            return _ranks(np.array([view[p].tobytes() for p in at], object))
    return bucket


def repeats(docs: np.ndarray, lo: np.ndarray, n: np.ndarray, pieces, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, start, end) of runs of windows that start earlier in one of the contexts ``pieces`` (an Arrow column)."""
    data, ends = laid_out(pieces)
    base = np.concatenate([[0], ends[:-1]])
    piece = np.repeat(np.arange(len(n)), n)
    inner = np.arange(len(piece)) - np.repeat(np.cumsum(n) - n, n)
    at = base[piece] + inner
    alive, bucket = refined(data, at, length)
    bucket = _exact(data, at[alive], bucket, length)
    piece, start = piece[alive], lo[piece[alive]] + inner[alive]
    order = np.lexsort((start, docs[piece], bucket))
    later = np.zeros(len(alive), bool)
    later[order[1:]] = bucket[order[1:]] == bucket[order[:-1]]
    piece, start = piece[later], start[later]  # still by piece and place
    new = np.ones(len(piece), bool)
    new[1:] = (piece[1:] != piece[:-1]) | (start[1:] != start[:-1] + 1)
    head = np.flatnonzero(new)
    tail = np.concatenate([head[1:], [len(piece)]])[: len(head)] - 1
    return docs[piece[head]], start[head], start[tail] + length


def _hot(scratch: Scratch, named: DataFrame, hot: int) -> DataFrame:
    """The q-grams of buckets that are too large for one task: at most 2 * SHARE of them, found from a 64th of the rows."""
    rows = named.filter("g is not null")
    least = max(hot, rows.count() // SHARE)
    look = LOOK if least >= 64 * LOOK else 1
    return scratch.table("hot", rows.filter(F.pmod(F.xxhash64("doc", "lo"), F.lit(look)) == 0).groupBy("g").count().filter(F.col("count") > least // (2 * look)).select("g"))


def _keyed(rows: DataFrame) -> DataFrame:
    """``rows`` with ``doc``, a number in the order of ids: the id itself unless ids are null or repeat; then nulls come first and equal ids by their texts' digests."""
    odd = rows.groupBy("doc_id").count().filter("count > 1 or doc_id is null")
    if odd.isEmpty():
        return rows.withColumn("doc", F.col("doc_id"))
    return numbered(rows.withColumn("h", F.sha2(F.col("text").cast("binary"), 256)).withColumn("salt", F.rand(13)), ["doc_id", "h", "salt"], "doc").drop("h", "salt")


def removed_runs(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, hot: int = HOT, most: int = MOST, cell: int = CELL, held: int = HELD) -> DataFrame:
    """(doc, s, e): runs of removed bytes, which may overlap, of ``docs`` (doc: unique and ordered, text)."""
    spark: SparkSession = docs.sparkSession
    scratch = Scratch(spark, "suffixes")
    named = scratch.table("named", _named(docs.select("doc", "text"), length, gram, held))
    busy = F.broadcast(_hot(scratch, named, hot))  # its size is bounded: see there
    run = ["doc", F.col("lo").alias("s"), (F.col("lo") + F.col("n") + (length - 1)).alias("e")]
    rows = named.filter("g is not null")
    bucket, same = W.partitionBy("g"), W.partitionBy("g", "c").orderBy("doc", "lo")
    cold = rows.join(busy, "g", "left_anti").withColumn("total", F.count("*").over(bucket)).filter("total > 1").withColumn("nth", F.row_number().over(same)).withColumn("kinds", F.sum(F.when(F.col("nth") == 1, 1).otherwise(0)).over(bucket))
    live = scratch.table("live", cold.filter("nth > 1 or kinds > 1").select("g", "doc", "lo", "n", "nth", "kinds"))
    warm = rows.join(busy, "g", "left_semi")
    first = scratch.table("first", warm.groupBy("g", "c").agg(F.min(F.struct("doc", "lo", "n")).alias("f")))
    again = scratch.table("again", warm.join(first, ["g", "c"]).filter(F.struct("doc", "lo") != F.struct("f.doc", "f.lo")).select(*run))
    gone = scratch.table("gone", named.filter("g is null").select(*run).union(live.filter("nth > 1").select(*run)).union(again))
    mixed = scratch.table("mixed", live.filter("nth = 1").select("g", "doc", "lo", "n", "kinds").union(first.select("g", "f.*", F.lit(most + 1).cast("bigint"))))
    scratch.drop("named", "live", "again")
    cells = max(1, mixed.count() // cell)
    place = F.when(F.col("kinds") <= most, F.pmod(F.xxhash64("g"), F.lit(cells))).otherwise(-1)
    spans = mixed.groupBy("doc").agg(F.collect_list(F.struct("lo", "n", place.alias("cell"))).alias("spans")).withColumnRenamed("doc", "d")

    def cut(batches):
        import pyarrow as pa

        for b in batches:
            if not b.num_rows:
                continue
            data, ends = laid_out(b.column("text"))
            lists = b.column("spans")
            row = np.repeat(np.arange(b.num_rows), np.asarray(lists.value_lengths()))
            lo, n, at = (np.asarray(lists.flatten().field(k)) for k in range(3))
            base = np.concatenate([[0], ends[:-1]])[row] + lo
            body = memoryview(data)
            for k in range(0, len(row), 1 << 14):
                part = slice(k, k + (1 << 14))
                piece = pa.array([bytes(body[s:e]) for s, e in zip(base[part].tolist(), (base[part] + n[part] + length - 1).tolist(), strict=True)], pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(at[part]), pa.array(np.asarray(b.column("doc"))[row[part]]), pa.array(lo[part]), pa.array(n[part]), piece], names=["cell", "doc", "lo", "n", "piece"])

    texts = docs.select("doc", "text").join(spans.hint("shuffle_hash"), F.col("doc") == F.col("d")).select("doc", "text", "spans")
    pieces = scratch.table("pieces", texts.mapInArrow(cut, "cell bigint, doc bigint, lo bigint, n int, piece binary"))
    scratch.drop("mixed", "first")

    def refine(key, t):
        import pyarrow as pa

        found = repeats(*(np.asarray(t.column(c).combine_chunks()) for c in ("doc", "lo", "n")), t.column("piece"), length)
        return pa.table([pa.array(x) for x in found], names=["doc", "s", "e"])

    def windows(batches):
        import pyarrow as pa

        for b in batches:
            for doc, lo, n, piece in zip(*(b.column(c).to_pylist() for c in ("doc", "lo", "n", "piece")), strict=True):
                names = [hashlib.blake2b(piece[k : k + length], digest_size=16).digest() for k in range(n)]
                yield pa.RecordBatch.from_arrays([pa.array(names, pa.binary()), pa.array([doc] * n, pa.int64()), pa.array(range(lo, lo + n), pa.int64())], names=["w", "doc", "p"])

    near = pieces.filter("cell >= 0").groupBy("cell").applyInArrow(refine, "doc bigint, s bigint, e bigint")
    wide = scratch.table("windows", pieces.filter("cell < 0").select("doc", "lo", "n", "piece").mapInArrow(windows, "w binary, doc bigint, p bigint"))
    starts = scratch.table("starts", wide.groupBy("w").agg(F.min(F.struct("doc", "p")).alias("f"), F.count("*").alias("k")).filter("k > 1").select("w", "f"))
    far = wide.join(starts, "w").filter(F.struct("doc", "p") != F.col("f")).select("doc", F.col("p").alias("s"), (F.col("p") + length).alias("e"))
    found = scratch.table("found", near.union(far))
    scratch.drop("pieces", "windows", "starts")
    return gone.union(found)


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **limits: int) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of every row of ``docs``.

    Texts are UTF-8 bytes, null is empty, and no match crosses documents. A
    byte is removed if a window of LENGTH bytes over it also starts earlier;
    all windows are judged on the input, overlaps count. n_spans is the number
    of maximal removed runs. Texts under LENGTH bytes lose nothing. A null id
    comes before all others, rows that repeat an id come in the order of their
    texts' digests, and of equal rows one is the first. Other columns are not read.

    Contexts, not windows, are shuffled, and only those that share a q-gram
    with another get as far as the texts. Equal contexts shrink to one a task
    first; buckets that hold more than ``hot`` rows, or more than ``most``
    different contexts, are never brought together: they go by aggregates and
    joins of written tables.
    """
    Scratch(docs.sparkSession, "texts")  # bounds Arrow batches
    rows = slim(docs, doc_id=id_col, text=text_col).select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = _keyed(rows)
    lists = removed_runs(rows, **limits).groupBy(F.col("doc").alias("d")).agg(F.collect_list("s").alias("s"), F.collect_list("e").alias("e"))

    def cut(batches):
        import pyarrow as pa

        for b in batches:
            data, ends = laid_out(b.column("text"))
            body, start, out = memoryview(data), 0, []
            sizes = np.asarray(b.column("s").value_lengths().fill_null(0))
            s, e = (np.asarray(b.column(c).flatten()) for c in ("s", "e"))
            at = 0
            for doc, end, k in zip(b.column("doc_id").to_pylist(), ends.tolist(), sizes.tolist(), strict=True):
                whole, kept, spans = hashlib.sha256(), end - start, 0
                if k:
                    order = np.argsort(s[at : at + k], kind="stable")
                    lo, hi = s[at : at + k][order], np.maximum.accumulate(e[at : at + k][order])
                    new = np.flatnonzero(np.concatenate([[True], lo[1:] > hi[:-1]]))
                    spans, place, kept = len(new), 0, 0
                    for a, z in zip(lo[new].tolist(), hi[np.concatenate([new[1:], [k]]) - 1].tolist(), strict=True):
                        whole.update(body[start + place : start + a])
                        kept, place = kept + a - place, z
                    whole.update(body[start + place : end])
                    kept += end - start - place
                else:
                    whole.update(body[start:end])
                out.append((doc, end - start, end - start - kept, spans, whole.hexdigest()))
                at, start = at + k, end
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out, strict=True), (pa.int64(),) * 4 + (pa.string(),), strict=True)] if out else [pa.array([], t) for t in (pa.int64(),) * 4 + (pa.string(),)], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    joined = rows.join(lists.hint("shuffle_hash"), F.col("doc") == F.col("d"), "left").select("doc_id", "text", "s", "e")
    return joined.mapInArrow(cut, "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string")
