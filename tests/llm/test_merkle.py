from __future__ import annotations

import hashlib

import pytest
from pyspark.sql import functions as F

from stratawork.llm import merkle
from stratawork.llm.support import Scratch


def sha(x: str) -> str:
    return hashlib.sha256(x.encode()).hexdigest()


def tree(leaves):
    """(root, proofs): siblings of each leaf, level by level, as (before, after)."""
    paths, at, nodes = [[] for _ in leaves], list(range(len(leaves))), list(leaves)
    while len(nodes) > 1:
        for leaf in range(len(leaves)):
            run, slot = divmod(at[leaf], 16)
            group = nodes[16 * run : 16 * run + 16]
            paths[leaf].append(("".join(group[:slot]), "".join(group[slot + 1 :])))
            at[leaf] = run
        nodes = [sha("".join(nodes[k : k + 16])) for k in range(0, len(nodes), 16)]
    return nodes[0], paths


def leaf(row):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def brute(rows, tampered):
    by = {}
    for r in rows:
        by.setdefault(r[1], []).append(r)
    sources = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    subs, inner = [], {}
    for s in sources:
        by[s].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        root, inner[s] = tree([leaf(r) for r in by[s]])
        subs.append(root)
    root, outer = tree(subs)
    out = []
    for k, s in enumerate(sources):
        for r, path in zip(by[s], inner[s], strict=True):
            whole = path + outer[k]
            changed = (*r[:4], r[4] and "".join(c.lower() if "A" <= c <= "Z" else c for c in r[4])) if tampered(r) else r
            h = leaf(changed)
            for a, b in whole:
                h = sha(a + h + b)
            out.append((r[0], leaf(r), subs[k], root, sha("".join(a + b for a, b in whole)), h, h == root))
    return sorted(out, key=str)


def _rows(sources: int, hot: int):
    rows = [(i, f"s{i % sources}", "en", i, f"Text {i}") for i in range(sources * 2)]
    rows += [(1000 + i, "hot", None, None, f"Ünïcode {i} {'x' * i}") for i in range(hot)]
    rows += [(7, None, None, 3, None), (8, "", "de", 0, ""), (9, "S", "de", 0, "A" * 100_000), (None, "hot", "en", 1, "a"), (None, "hot", "en", 1, "a"), (None, None, None, None, None), (5, "é", "en", 1, "lower case"), (5, "é", "en", 1, "Other")]
    return rows


@pytest.mark.parametrize(("sources", "hot"), [(3, 300), (40, 17), (1, 1)])
def test_brute_force(spark, sources, hot):
    import zlib

    rows = _rows(sources, hot)
    schema = "doc_id bigint, source string, lang string, n_chars int, text string, k bigint, pre string, path int"
    docs = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], schema).repartition(5)
    fifth = lambda r: r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0
    got = merkle.manifest(docs, merkle.every_fifth(F.col("doc_id")))
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(rows, fifth)
    assert all(r["verified"] for r in merkle.manifest(docs).collect())


def test_one_source_and_none(spark):
    schema = "doc_id bigint, source string, lang string, n_chars int, text string"
    one = spark.createDataFrame([(1, "a", "en", 1, "X")], schema)
    r = merkle.manifest(one, F.lit(True)).first()
    assert r["leaf"] == r["subroot"] == r["root"] == leaf((1, "a", "en", 1, "X")) and r["proof_sha256"] == sha("") and not r["verified"]
    empty = merkle.manifest(one.limit(0))
    assert empty.count() == 0 and empty.columns == merkle.manifest(one).columns


def test_paths_fold(spark):
    """A stored path gives siblings by cutting a slot out and another root by filling it."""
    pre = "".join(sha(str(k)) for k in range(5))
    df = spark.createDataFrame([([(pre, 2)], "f" * 64)], "path array<struct<pre:string,slot:int>>, h string")
    got = df.select(merkle.siblings(F.col("path")).alias("s"), merkle.fold(F.col("h"), F.col("path")).alias("r")).first()
    assert got["s"] == pre[:128] + pre[192:] and got["r"] == sha(pre[:128] + "f" * 64 + pre[192:])


def test_nodes_are_groups_of_sixteen(spark):
    nodes = spark.range(1000).select(F.lit(0).cast("bigint").alias("k"), F.col("id").alias("i"), F.sha2(F.col("id").cast("string").cast("binary"), 256).alias("h"), F.lit(1000).cast("bigint").alias("m"))
    levels, top = merkle.grow(Scratch(spark, "t"), nodes, 3, "g")
    assert [x.count() for x in levels] == [63, 4, 1] and levels[0].agg(F.max(F.length("pre"))).first()[0] == 16 * 64
    assert top.collect()[0]["h"] == tree([sha(str(i)) for i in range(1000)])[0]
