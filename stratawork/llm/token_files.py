"""Token ids on disk in patched frame-of-reference blocks.

A file holds a run of documents in order: magic, counts, the documents' ids,
which of them are null, and token counts, an index of block starts, then the
blocks. A block of 128
ids keeps its minimum, the width at which the chosen percentile of its
differences fits, the packed low bits, and an exception list (place, high
bits) for outliers.
"""

from __future__ import annotations

import struct
import zlib
from array import array

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratawork.llm.support import Scratch, open_reader, slim, write_file
from stratawork.llm.tokens import encoder

MAGIC, BLOCK, PERCENTILE = b"PFR2", 128, 90
#: Tokens after which a partition starts a new file; bounds what a reader or writer holds.
FILE_TOKENS = 1 << 22


def _pack(values: np.ndarray, width: int) -> np.ndarray:
    """Rows of BLOCK numbers below 2**width as rows of little-endian 64-bit words."""
    out = np.zeros((len(values), BLOCK * width // 64), np.uint64)
    for j in range(BLOCK):
        word, shift = divmod(j * width, 64)
        out[:, word] |= values[:, j] << np.uint64(shift)
        if shift + width > 64:
            out[:, word + 1] |= values[:, j] >> np.uint64(64 - shift)
    return out


def _unpack(words: np.ndarray, width: int) -> np.ndarray:
    out = np.zeros((len(words), BLOCK), np.uint64)
    mask = np.uint64((1 << width) - 1)
    for j in range(BLOCK):
        word, shift = divmod(j * width, 64)
        got = words[:, word] >> np.uint64(shift)
        if shift + width > 64:
            got = got | (words[:, word + 1] << np.uint64(64 - shift))
        out[:, j] = got & mask
    return out


def encode_blocks(ids: np.ndarray, percentile: int = PERCENTILE, stretch: int = 1 << 11) -> tuple[np.ndarray, bytes]:
    """(block starts in bytes, one more than blocks; body) of unsigned 32-bit ids, ``stretch`` blocks at a time."""
    starts, bodies = [np.zeros(1, np.uint64)], []
    for at in range(0, len(ids), stretch * BLOCK):
        s, body = _encode(ids[at : at + stretch * BLOCK], percentile)
        starts.append(s[1:] + starts[-1][-1])
        bodies.append(body)
    return np.concatenate(starts), b"".join(bodies)


def _encode(ids: np.ndarray, percentile: int) -> tuple[np.ndarray, bytes]:
    """``encode_blocks`` of one stretch; the last block is padded with its last id."""
    n = len(ids)
    blocks = -(-n // BLOCK)
    v = np.empty(blocks * BLOCK, np.uint64)
    v[:n], v[n:] = ids, ids[-1]
    v = v.reshape(blocks, BLOCK)
    low = v.min(axis=1)
    diff = v - low[:, None]
    at = min(BLOCK - 1, BLOCK * percentile // 100)
    chosen = np.partition(diff.astype(np.uint32), at, axis=1)[:, at]
    width = np.ceil(np.log2(chosen.astype(np.float64) + 1)).astype(np.int64)
    limit = np.left_shift(np.uint64(1), width.astype(np.uint64))
    over = diff >= limit[:, None]
    n_over = over.sum(axis=1)
    size = 8 + BLOCK * width // 8 + 5 * n_over  # head: minimum 4, width 1, exceptions 1, spare 2
    starts = np.zeros(blocks + 1, np.uint64)
    starts[1:] = np.cumsum(size)
    body = np.zeros(int(starts[-1]), np.uint8)
    at8 = starts[:-1].astype(np.int64)
    head = np.zeros((blocks, 8), np.uint8)
    head[:, :4] = low.astype("<u4").view(np.uint8).reshape(blocks, 4)
    head[:, 4], head[:, 5] = width, n_over
    body[at8[:, None] + np.arange(8)] = head
    for w in np.unique(width):
        rows = np.flatnonzero(width == w)
        if w:
            packed = _pack(diff[rows] & (limit[rows, None] - np.uint64(1)), int(w)).astype("<u8").view(np.uint8).reshape(len(rows), -1)
            body[(at8[rows] + 8)[:, None] + np.arange(packed.shape[1])] = packed
    r, c = np.nonzero(over)
    if len(r):
        nth = np.arange(len(r)) - np.concatenate([[0], np.cumsum(n_over)])[r]
        place = at8[r] + 8 + BLOCK * width[r] // 8 + 5 * nth
        high = (diff[r, c] >> width[r].astype(np.uint64)).astype("<u4").view(np.uint8).reshape(-1, 4)
        body[place] = c
        body[place[:, None] + np.arange(1, 5)] = high
    return starts, body.tobytes()


def decode_blocks(starts: np.ndarray, body: bytes, n: int, first: int = 0) -> np.ndarray:
    """The ids of whole blocks; ``body`` begins at the start of block ``first``, n counts ids from there."""
    blocks = len(starts) - 1
    if blocks <= 0 or not n:
        return np.zeros(0, np.uint32)
    raw = np.frombuffer(body, np.uint8)
    at = starts[:-1].astype(np.int64) - int(starts[0])
    head = raw[at[:, None] + np.arange(8)]
    low = np.ascontiguousarray(head[:, :4]).view("<u4").ravel().astype(np.uint64)
    width, n_over = head[:, 4].astype(np.int64), head[:, 5].astype(np.int64)
    out = np.zeros((blocks, BLOCK), np.uint64)
    for w in np.unique(width):
        if w:
            rows = np.flatnonzero(width == w)
            words = np.ascontiguousarray(raw[(at[rows] + 8)[:, None] + np.arange(BLOCK * int(w) // 8)]).view("<u8")
            out[rows] = _unpack(words, int(w))
    if n_over.sum():
        r = np.repeat(np.arange(blocks), n_over)
        nth = np.arange(len(r)) - np.concatenate([[0], np.cumsum(n_over)])[r]
        place = at[r] + 8 + BLOCK * width[r] // 8 + 5 * nth
        high = np.ascontiguousarray(raw[place[:, None] + np.arange(1, 5)]).view("<u4").ravel().astype(np.uint64)
        out[r, raw[place]] |= high << width[r].astype(np.uint64)
    return (out + low[:, None]).ravel()[:n].astype(np.uint32)


def file_bytes(doc_ids: list[int | None], counts: list[int], ids: bytes) -> bytes:
    v = np.frombuffer(ids, "<u4")
    starts, body = encode_blocks(v)
    head = MAGIC + struct.pack("<QQQ", len(doc_ids), len(v), len(starts) - 1)
    null = np.packbits([d is None for d in doc_ids]).tobytes()
    return b"".join((head, np.asarray([d or 0 for d in doc_ids], "<i8").tobytes(), null, np.asarray(counts, "<u8").tobytes(), starts.astype("<u8").tobytes(), body))


class TokenFile:
    """What an open file says before its blocks: documents, their token counts, and where blocks start."""

    def __init__(self, f, uri: str):
        if f.read(4) != MAGIC:
            raise ValueError(f"{uri} is not a token file")
        docs, self.tokens, self.blocks = struct.unpack("<QQQ", f.read(24))
        ids = np.frombuffer(f.read(8 * docs), "<i8")
        null = np.unpackbits(np.frombuffer(f.read(-(-docs // 8)), np.uint8), count=docs)
        self.ids = [None if x else d for d, x in zip(ids.tolist(), null.tolist(), strict=True)]
        self.counts = np.frombuffer(f.read(8 * docs), "<u8").astype(np.int64)
        self.starts = np.frombuffer(f.read(8 * (self.blocks + 1)), "<u8")
        self.body = 28 + 8 * docs + -(-docs // 8) + 8 * docs + 8 * (self.blocks + 1)


def read_documents(uri: str, window: int = 1 << 11):
    """(doc id, its ids) in file order; holds ``window`` blocks at a time besides the current document."""
    with open_reader(uri) as f:
        t = TokenFile(f, uri)
        have, done = np.zeros(0, np.uint32), 0
        for doc, count in zip(t.ids, t.counts.tolist(), strict=True):
            parts, lack = [], count
            while lack > len(have):
                parts.append(have)
                lack -= len(have)
                to = min(t.blocks, done + window)
                body = f.read(int(t.starts[to] - t.starts[done]))
                have = decode_blocks(t.starts[done : to + 1], body, min(t.tokens - done * BLOCK, (to - done) * BLOCK))
                done = to
            parts.append(have[:lack])
            have = have[lack:]
            yield doc, parts[0] if len(parts) == 1 else np.concatenate(parts)


def read_range(uri: str, first: int, count: int) -> np.ndarray:
    """``count`` ids from place ``first`` of a file; the index names the blocks that hold them, no other is read."""
    with open_reader(uri) as f:
        t = TokenFile(f, uri)
        first, end = max(0, min(first, t.tokens)), max(0, min(first + count, t.tokens))
        if first >= end:
            return np.zeros(0, np.uint32)
        a, b = first // BLOCK, -(-end // BLOCK)
        f.seek(t.body + int(t.starts[a]))
        ids = decode_blocks(t.starts[a : b + 1], f.read(int(t.starts[b] - t.starts[a])), min(t.tokens - a * BLOCK, (b - a) * BLOCK))
        return ids[first - a * BLOCK : end - a * BLOCK]


def write_token_files(df: DataFrame, path: str, root: str, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Writes ids in ascending id order as files under ``root``; gives (part, file, uri, docs, tokens).

    Texts are dealt by ranges of the id, which are even for any hot column,
    and encoded and written where they are sorted: ids never cross the
    network. A row is the manifest entry of a file. Files are renamed when
    whole and named by place, so a repeated task writes the same again. Null
    and empty texts are the end id alone; null ids come first; a repeated id
    keeps each row, in the order of the text's hash. Ranges are of the id, that
    hash and a random number, so that no id and no repeated row is too much for
    one of them.
    """
    end = array("I", [end_id]).tobytes()
    rows = slim(df, id=id_col, text=text_col).select(F.col("id").cast("bigint").alias("id"), "text", F.xxhash64("text").alias("h"), F.rand(7).alias("r"))
    ordered = rows.repartitionByRange("id", "h", "r").sortWithinPartitions("id", "h").select("id", "text")

    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        enc, part = encoder(path), TaskContext.get().partitionId()
        made, docs, counts, ids, size = [], [], [], [], 0

        def flush():
            nonlocal docs, counts, ids, size
            if docs:
                uri = f"{root}/{part:07d}-{len(made):05d}.pfr"
                write_file(uri, file_bytes(docs, counts, b"".join(ids)))
                made.append((part, len(made), uri, len(docs), size))
                docs, counts, ids, size = [], [], [], 0

        for b in batches:
            for doc, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                data = enc.ids(text) + end
                docs.append(doc)
                counts.append(len(data) // 4)
                ids.append(data)
                size += len(data) // 4
                if size >= FILE_TOKENS:
                    flush()
        flush()
        cols = list(zip(*made, strict=True)) or [()] * 5
        kinds = (pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=["part", "file", "uri", "docs", "tokens"])

    return ordered.mapInArrow(run, "part int, file int, uri string, docs bigint, tokens bigint")


def read_token_files(manifest: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(id, start, n_tokens, ids_crc32) of every document, from the files alone.

    The manifest has one row a file of millions of tokens. Running sums are of
    files within a partition, and of the partitions' totals, one number each;
    then each file is a task.
    """
    from pyspark.sql import Window

    n = max(1, manifest.count())
    sum_ = lambda c, w: F.coalesce(F.sum(c).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = manifest.groupBy("part").agg(F.sum("tokens").alias("t")).select("part", sum_("t", Window.orderBy("part")).alias("base"))
    files = manifest.select("uri", "part", sum_("tokens", Window.partitionBy("part").orderBy("file")).alias("own")).join(parts, "part")
    files = files.select("uri", (F.col("own") + F.col("base")).alias("before")).repartition(n)

    def run(batches):
        import pyarrow as pa

        for b in batches:
            for uri, at in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                out = []
                for doc, ids in read_documents(uri):
                    out.append((doc, at, len(ids), zlib.crc32(ids.astype("<u4").tobytes())))
                    at += len(ids)
                cols = list(zip(*out, strict=True)) or [()] * 4
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=["id", "start", "n_tokens", "ids_crc32"])

    return files.mapInArrow(run, "id bigint, start bigint, n_tokens bigint, ids_crc32 bigint").withColumnRenamed("id", id_col)


def round_trip(df: DataFrame, path: str, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Writes the token files of ``df`` and reads them back (``write_token_files``, ``read_token_files``)."""
    scratch = Scratch(df.sparkSession, "tokens")
    manifest = scratch.table("manifest", write_token_files(df, path, scratch.path("files"), end_id, id_col, text_col))
    return read_token_files(manifest, id_col)
