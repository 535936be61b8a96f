from __future__ import annotations

import itertools
import random
import zlib
from array import array

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from stratawork.llm import packing, token_files
from stratawork.llm.tokens import Encoder, count_tokens, spliced


@pytest.fixture(scope="module")
def library(vocab):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(vocab("word_bpe_49k.json"))


@pytest.fixture(scope="module")
def enc(vocab):
    return Encoder(vocab("word_bpe_49k.json"))


def _ids(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


ODD = ["", " ", "don't STOP'S it''s 'S", "áb é É İx ŉ ²3 x²y", "<|endoftext|> a<|startoftext|>b <|ENDOFTEXT|>", "日本語 and é", "x" * 3000, "ab " * 2000, "a ́b c " * 200, "t\tn\x0b\x0c\x1c\x85\xa0e so\xadft", "ΑΣ ΟΔΟΣ"]


@pytest.mark.parametrize("text", ODD)
def test_encoder_equals_the_library(enc, library, text):
    assert array("I", enc.ids(text)).tolist() == _ids(library, text)


def test_splicing_equals_the_library_and_widens(enc, library):
    random.seed(4)
    texts = ODD + ["".join(random.choice("ab é'sS.,!\n\t<|>12²́") for _ in range(1500)) for _ in range(10)]
    failed = []
    for t in texts:
        for chunk, overlap in ((64, 8), (1000, 4)):
            assert [i for p in spliced(enc, t, chunk, overlap, failed.append) for i in array("I", p)] == _ids(library, t)
    assert failed


def test_counts(docs, corpus, vocab, library):
    got = count_tokens(docs, vocab("word_bpe_49k.json"), chunk=2000, overlap=16).collect()
    want = sorted([(i, len((t or "").encode()), len(_ids(library, t))) for i, t in corpus] + [(-1, 0, 0)])
    assert sorted((-1 if r[0] is None else r[0], r[1], r[2]) for r in got) == want
    assert all(r["over_limit"] == (r["n_tokens"] > 2048) for r in got)
    assert count_tokens(docs.limit(0), vocab("word_bpe_49k.json")).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 60), st.integers(0, 2**32 - 1)), max_size=700), st.sampled_from([0, 50, 90, 100]))
def test_blocks_round_trip(values, percentile):
    ids = np.array(values, np.uint32)
    starts, body = token_files.encode_blocks(ids, percentile, stretch=2)
    assert (token_files.decode_blocks(starts, body, len(ids)) == ids).all()


def test_token_files(docs, corpus, vocab, library):
    got = token_files.round_trip(docs, vocab("word_bpe_49k.json")).orderBy("start").collect()
    assert [r["doc_id"] for r in got] == [None, *sorted(i for i, _ in corpus)]
    assert all(a["start"] + a["n_tokens"] == b["start"] for a, b in zip(got, got[1:], strict=False)) and got[0]["start"] == 0
    texts = dict(corpus)
    for r in got:
        ids = [*_ids(library, texts.get(r["doc_id"])), 1]
        assert (r["n_tokens"], r["ids_crc32"]) == (len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
    assert token_files.round_trip(docs.limit(0), vocab("word_bpe_49k.json")).count() == 0


def test_packing(docs, corpus, vocab, library):
    got = packing.pack_documents(docs, vocab("word_bpe_49k.json")).collect()
    seqs: dict[int, list] = {}
    for r in got:
        seqs.setdefault(r["sequence_id"], []).append(r)
    for rows in seqs.values():
        at = 0
        for r in sorted(rows, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= 2048
    tokens = sum(len(_ids(library, t)) + 1 for _, t in corpus) + 1
    assert sum(r["length"] for r in got) == tokens and len(seqs) <= tokens // 2048 + 2
    one = sorted((r["piece"], r["start"], r["length"]) for r in got if r["doc_id"] == 34)
    n = len(_ids(library, dict(corpus)[34])) + 1
    assert one == [(k, a, min(2048, n - a)) for k, a in enumerate(range(0, n, 2048))]
    assert packing.pack_documents(docs.limit(0), vocab("word_bpe_49k.json")).count() == 0


@pytest.mark.parametrize("seed", range(6))
def test_swap_search_raises_the_squared_fill(seed):
    r = random.Random(seed)
    lengths = [r.randint(1, 60) for _ in range(120)]
    bins, at = [], 0
    while at < len(lengths):  # a poor start: next fit
        b, fill = [], 0
        while at < len(lengths) and fill + lengths[at] <= 100:
            b.append(at)
            fill += lengths[at]
            at += 1
        bins.append(b)
    square = lambda bs: sum(sum(lengths[k] for k in b) ** 2 for b in bs)
    out = packing.swap_search(bins, lengths, 100)
    assert sorted(k for b in out for k in b) == list(range(len(lengths)))
    assert all(sum(lengths[k] for k in b) <= 100 for b in out)
    assert square(out) > square(bins) and len(out) < len(bins)
    best = packing.best_fit(lengths, 100)
    assert len(packing.swap_search(best, lengths, 100)) <= len(best)


def _fewest(lengths, capacity):
    """Bins of an optimal packing, by branch and bound."""
    lengths, best = sorted(lengths, reverse=True), [len(lengths)]

    def place(k, rooms):
        if len(rooms) >= best[0]:
            return
        if k == len(lengths):
            best[0] = len(rooms)
            return
        for room in sorted({r for r in rooms if r >= lengths[k]}):
            rest = list(rooms)
            rest.remove(room)
            place(k + 1, [*rest, room - lengths[k]])
        place(k + 1, [*rooms, capacity - lengths[k]])

    place(0, [])
    return best[0]


@pytest.mark.parametrize("seed", range(12))
def test_packing_is_near_the_optimum(seed):
    r = random.Random(seed)
    lengths = [r.randint(1, 20) for _ in range(11)]
    best = _fewest(lengths, 20)
    for limits in ({}, {"donors": None, "widest": None}):
        out = packing.swap_search(packing.best_fit(lengths, 20), lengths, 20, **limits)
        assert best <= len(out) <= best + 1 and sorted(k for b in out for k in b) == list(range(11))
        assert all(sum(lengths[k] for k in b) <= 20 for b in out)


def test_no_exchange_is_left():
    """By default exchanges are sought with all bins and in bins of any number of pieces: brute force finds none that helps."""
    r = random.Random(8)
    lengths = [r.choice((r.randint(300, 560), r.randint(1, 9))) for _ in range(900)]
    bins = packing.swap_search(packing.best_fit(lengths, 1024), lengths, 1024)
    assert sorted(k for b in bins for k in b) == list(range(900))
    kinds = [{(lengths[k],) for k in b} | {(lengths[x], lengths[y]) for x, y in itertools.combinations(b, 2)} | {()} for b in bins]
    fill = [sum(lengths[k] for k in b) for b in bins]
    for i, j in itertools.permutations(range(len(bins)), 2):
        if fill[j] <= fill[i] < 1024:
            gains = {sum(y) - sum(x) for x in kinds[i] for y in kinds[j] if 0 < len(x) + len(y) < 4 and not (x == () and len(y) == 2)}
            assert not any(0 < d <= 1024 - fill[i] for d in gains)
    # 47 + 46 of the ninth emptiest bin fill the first up in place of 92
    lengths = [92, 4, 47, 46] + [90] * 8
    bins = [[0, 1], [2, 3], *([k] for k in range(4, 12))]
    assert 97 not in {sum(lengths[k] for k in b) for b in packing.swap_search(bins, lengths, 97, donors=8, widest=64)}
    assert 97 in {sum(lengths[k] for k in b) for b in packing.swap_search(bins, lengths, 97)}


def test_repeated_rows_are_dealt_to_all_shards(spark, vocab):
    d = spark.range(3000).select(F.lit(None).cast("bigint").alias("doc_id"), F.lit(None).cast("string").alias("text"))
    rows = packing.pieces(d, vocab("word_bpe_49k.json"))
    got = packing.pack(rows, 2048, shard_pieces=300).groupBy((F.col("sequence_id") / 2**32).cast("int").alias("shard")).count().collect()
    assert len(got) == 10 and max(r["count"] for r in got) < 600


def test_files_are_sought_by_their_index(tmp_path, vocab):
    rng = np.random.default_rng(3)
    ids = np.where(rng.random(5000) < 0.05, rng.integers(0, 2**32, 5000), rng.integers(0, 900, 5000)).astype(np.uint32)
    path = str(tmp_path / "f.pfr")
    with open(path, "wb") as f:
        f.write(token_files.file_bytes([4, None, 9], [1000, 0, 4000], ids.tobytes()))
    for a, n in ((0, 5), (127, 2), (1290, 700), (4999, 1), (4990, 100), (5000, 3), (0, 5000)):
        assert (token_files.read_range(path, a, n) == ids[a : a + n]).all()
    assert [(d, len(x)) for d, x in token_files.read_documents(path)] == [(4, 1000), (None, 0), (9, 4000)]


def test_null_and_negative_ids_keep_their_place(spark, vocab):
    d = spark.createDataFrame([(-1, "a b"), (None, "c"), (-5, "d"), (None, "c"), (7, None)], "doc_id bigint, text string")
    got = token_files.round_trip(d, vocab("word_bpe_49k.json")).orderBy("start").collect()
    assert [r["doc_id"] for r in got] == [None, None, -5, -1, 7] and [r["n_tokens"] for r in got] == [2, 2, 2, 3, 1]


def test_a_huge_text_without_spaces(spark, vocab, library, enc):
    text = "".join(chr(0x4E00 + (i * 7919) % 5000) for i in range(120_000))
    d = spark.createDataFrame([(1, text), (2, text[:50_000] + " end")], "doc_id bigint, text string")
    want = {1: len(_ids(library, text)), 2: len(_ids(library, text[:50_000] + " end"))}
    assert {r["doc_id"]: r["n_tokens"] for r in count_tokens(d, vocab("word_bpe_49k.json")).collect()} == want
    assert {r["doc_id"]: r["n_tokens"] for r in token_files.round_trip(d, vocab("word_bpe_49k.json")).collect()} == {k: n + 1 for k, n in want.items()}
    for w in ("q" * 100_000, "ab" * 60_000):
        assert array("I", enc.ids(w)).tolist() == _ids(library, w)
    assert max(map(len, enc.words), default=0) <= 48


def test_registered_queries_equal_the_library(spark, library):
    """op2, op4 and op7 as registered, over the whole smallest table."""
    from stratawork.llm import queries

    sf = "/root/testdata/sf0.001"
    docs = sorted((r["doc_id"], r["text"] or "") for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect())
    ids = {d: _ids(library, t) for d, t in docs}
    assert sorted((r["doc_id"], r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in queries.op2_token_counts(spark, sf).collect()) == [(d, len(t.encode()), len(ids[d]), len(ids[d]) > 2048) for d, t in docs]
    at, want = 0, []
    for d, _ in docs:
        x = np.array([*ids[d], 1], "<u4")
        want.append((d, at, len(x), zlib.crc32(x.tobytes())))
        at += len(x)
    assert sorted((r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) for r in queries.op4_token_files(spark, sf).collect()) == want
    want = []
    for d, _ in docs:
        x = np.array([*ids[d], 0], "<u4")
        want += [(d, k, a, len(x[a : a + 2048]), zlib.crc32(x[a : a + 2048].tobytes())) for k, a in enumerate(range(0, len(x), 2048))]
    got = queries.op7_best_fit_packing(spark, sf).collect()
    assert sorted((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == want
    assert len({r["sequence_id"] for r in got}) <= -(-sum(w[3] for w in want) // 2048) + 1
