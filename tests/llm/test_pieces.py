from __future__ import annotations

import random
import zlib

import numpy as np
import pytest

from stratawork.llm.pieces import _STRETCH, MARK, PieceModel, decode_pieces, encode_pieces, fields, piece_digests


@pytest.fixture(scope="module")
def data(vocab):
    with open(vocab("piece_bpe_32k.model"), "rb") as f:
        return f.read()


def _texts():
    random.seed(2)
    return ["", "a", " ", " a", "a ", "  a  b\n\tc　é𝄞", "日本語テスト", "▁a▁▁b", "<s> </s> <unk> <0x0A>", "ab" * 200, " " * 40 + "q" + " " * 17 + "z", "nul\0x"] + ["".join(random.choice("ab é'sS.,!\n\t  thein12日") for _ in range(300)) for _ in range(40)]


def test_equals_the_library(data):
    m = PieceModel(data)
    assert m.direct
    for t in _texts():
        ids = m.encode(t)
        assert ids == m.sp.encode(t), t
        assert m.decode(ids) == m.sp.decode(ids)


def test_viterbi_equals_the_library_in_unigram_mode(data):
    """The same pieces and scores with the model's type field set to unigram."""
    out = b""
    for n, _, v, a, b in fields(data):
        if n == 2:
            t = b"".join(v[x:y] if k != 3 else b"\x18\x01" for k, _, _, x, y in fields(v))
            size, length = len(t), b""
            while size > 127:
                length, size = length + bytes([size & 127 | 128]), size >> 7
            out += b"\x12" + length + bytes([size]) + t
        else:
            out += data[a:b]
    m = PieceModel(out)
    assert m.kind == 1 and m.direct
    lost = lambda ids: sum(m.score[i] for i in ids if i not in m.back)
    for t in _texts():
        ids, want = m.encode(t), m.sp.encode(t)
        assert ids == want or abs(lost(ids) - lost(want)) <= 1e-4 * abs(lost(want)), t  # equal up to ties


def test_best_sum_is_the_viterbi_pass(data):
    """The count of the pass that does both is that of the plain one; no segmentation into known pieces has a better sum."""
    m = PieceModel(data)
    for t in _texts():
        if "\0" in t or not t:
            continue
        parts = _STRETCH.findall((MARK if m.prefix else "") + t.replace(" ", MARK))
        assert m.measured(t)[2] == sum(len(m._spell(m._relaxed(p))) for p in parts)
    total = lambda ids: sum(m.score[i] for i in ids if i not in m.back)
    for w in ("▁there", "▁restitution", "▁aaaaab"):
        best = [i for i, _ in m._relaxed(w)]
        assert total(best) >= total(m.encode(w[1:])) - 1e-6


def test_columns(docs, corpus, data, vocab):
    path, m = vocab("piece_bpe_32k.model"), PieceModel(data)
    got = piece_digests(docs, path).collect()
    assert sorted((r["doc_id"] if r["doc_id"] is not None else -1, r["n_tokens"]) for r in got) == sorted([(i, len(m.sp.encode(t or ""))) for i, t in corpus] + [(-1, 0)])
    assert all(r["round_trip"] for r in got)
    back = decode_pieces(encode_pieces(docs, path), path).collect()
    assert sorted((r["doc_id"] or 0, r["text"]) for r in back) == sorted([(i, t or "") for i, t in corpus] + [(0, "")])


def test_long_runs_take_linear_time(data):
    """A run of spaces and a text without any: no square of the length, nothing long is kept."""
    import time

    m = PieceModel(data)
    for n in (500, 3001, 20_000):
        assert m.encode("a" + " " * n + "b") == m.sp.encode("a" + " " * n + "b")
    t = time.time()
    ids, back = m.encoded("a" + " " * 1_000_000 + "b")
    long = "".join(chr(0x4E00 + (i * 7919) % 3000) + "abc"[i % 3] for i in range(300_000))
    got, back2 = m.encoded(long)
    assert back and back2 and time.time() - t < 60
    assert len(got) // 4 == len(m.sp.encode(long))
    assert max(map(len, m.kept), default=0) <= 48


def test_merging_equals_the_library(data):
    """The heap of merges on whole texts, which the automaton's pass has to agree with."""
    m = PieceModel(data)
    for t in ["hello world", "aaaaaaaaaaaaaaaaaaaaaaa", "  " * 30, "thethethe theythem", "日本語テスト", "é𝄞x"]:
        s = (MARK if m.prefix else "") + t.replace(" ", MARK)
        assert m._spell(m._merged(s)) == m.sp.encode(t)


def test_registered_query(spark, vocab, data):
    from stratawork.llm import queries

    sf, m = "/root/testdata/sf0.001", PieceModel(data)
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()}
    got = queries.op6_piece_viterbi(spark, sf).collect()
    assert len(got) == len(texts)
    for r in got:
        ids = m.sp.encode(texts[r["doc_id"]])
        assert (r["n_tokens"], r["ids_crc32"]) == (len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        assert r["n_best_sum"] is None or 0 < r["n_best_sum"] or not ids
    assert piece_digests(spark.read.parquet(f"{sf}/documents.parquet").limit(0), vocab("piece_bpe_32k.model")).count() == 0
