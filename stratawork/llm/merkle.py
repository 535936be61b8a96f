"""A Merkle manifest of a dataset: leaves, subroots by source, one root, and for each leaf the proof that it belongs.

The proof of a leaf is its path of parent preimages: a parent stores the
digests of its children as one string, from which a leaf cuts its own slot to
get its siblings, or puts another digest there to fold a changed leaf up.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratawork.llm.support import Scratch, slim
from stratawork.operators.windows import numbered

#: Children of a node, characters of a digest, and bytes of source names up to which their table is broadcast.
BITS, WIDTH, SMALL = 4, 64, 16 << 20
_PATH = "array<struct<pre:string,slot:int>>"


def digest(*parts: Column) -> Column:
    """Lower-case hex SHA-256 of the parts' UTF-8 bytes one after the other."""
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def framed(value: Column) -> Column:
    """``-`` for null, else the byte count, a colon and the value: no two rows of fields give the same bytes."""
    text = value.cast("string")
    return F.when(text.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf(row: dict[str, Column]) -> Column:
    return digest(*(framed(row[c]) for c in ("doc_id", "source", "lang", "n_chars", "text")))


def _left(x: Column) -> Column:
    return x["pre"].substr(F.lit(1), x["slot"] * WIDTH)


def _right(x: Column) -> Column:
    return x["pre"].substr(x["slot"] * WIDTH + WIDTH + 1, F.length(x["pre"]))


def siblings(path: Column) -> Column:
    """The digests beside a node on its way up, level by level, left to right."""
    return F.array_join(F.transform(path, lambda x: F.concat(_left(x), _right(x))), "")


def fold(node: Column, path: Column) -> Column:
    """The root that a node's digest gives along a path, whatever stood in its slots."""
    return F.aggregate(path, node, lambda h, x: digest(_left(x), h, _right(x)))


def _slot() -> Column:
    return F.col("i").bitwiseAND(F.lit((1 << BITS) - 1)).cast("int")


def _height(nodes: int) -> int:
    levels = 0
    while nodes > 1:
        nodes, levels = -(-nodes >> BITS), levels + 1
    return levels


def grow(scratch: Scratch, nodes: DataFrame, height: int, name: str) -> tuple[list[DataFrame], DataFrame]:
    """The parents by level, (k, i, pre, h, m), and the last node of each key, (k, h).

    ``nodes`` are (k, i, h, m): place ``i`` from 0 among the ``m`` of key
    ``k``. A key is done when one node remains; a level groups at most 16 rows
    by their parent, so a hot key is many groups.
    """
    levels, tops = [], nodes.filter("m = 1").select("k", "h")
    for n in range(height):
        up = nodes.filter("m > 1").groupBy("k", F.shiftright("i", BITS).alias("i")).agg(F.array_sort(F.collect_list(F.struct("i", "h"))).alias("c"), F.first("m").alias("m"))
        up = up.select("k", "i", F.array_join(F.col("c.h"), "").alias("pre"), F.shiftright(F.col("m") + (1 << BITS) - 1, BITS).alias("m"))
        nodes = scratch.table(f"{name}{n}", up.withColumn("h", digest(F.col("pre"))))
        levels.append(nodes)
        tops = tops.union(nodes.filter("m = 1").select("k", "h"))
    return levels, tops


def _below(nodes: DataFrame, parents: DataFrame | None, tops: DataFrame) -> DataFrame:
    """``nodes`` with their path, subroot and root: below a parent its preimage comes first, the last of a key has the path of its key."""
    own = [c for c in nodes.columns if c not in ("k", "m")]
    t = tops.select("k", "path", "subroot", "root")
    out = nodes.filter("m = 1").join(t, "k").select("k", *own, "m", "path", "subroot", "root")
    if parents is None:
        return out
    up = parents.select(F.col("k").alias("pk"), F.col("i").alias("pi"), "pre", "path", "subroot", "root")
    if "pre" in own:
        up = up.withColumnRenamed("pre", "upper")
    pre = F.col("upper" if "pre" in own else "pre")
    step = F.array(F.struct(pre.alias("pre"), _slot().alias("slot")))
    many = nodes.filter("m > 1").join(up, (F.col("k") == F.col("pk")) & (F.shiftright("i", BITS) == F.col("pi")))
    return out.union(many.select("k", *own, "m", F.concat(step, "path").cast(_PATH).alias("path"), "subroot", "root"))


def descend(scratch: Scratch, levels: list[DataFrame], tops: DataFrame, nodes: DataFrame, name: str) -> DataFrame:
    """``nodes`` with the whole path above them: preimages go down level by level, a sixteenth of the rows at a time."""
    parents = None
    for n in range(len(levels) - 1, -1, -1):
        parents = scratch.table(f"{name}{n}", _below(levels[n].drop("h"), parents, tops))
    return _below(nodes, parents, tops)


def manifest(docs: DataFrame, tampered: Column | None = None) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) of every row of ``docs``.

    ``docs`` has doc_id, source, lang, n_chars and text; other columns are not
    read. Leaves of a source ascend by doc_id, nulls first, and rows that
    repeat an id by their digests; sources ascend bytewise, null first. Where
    ``tampered`` (over those five columns; null is false) holds, the text's
    A-Z are lower-cased before its leaf is folded up, and the row is verified
    only if that changes nothing. Empty and very long texts are leaves like
    others; equal rows are leaves each. No rows, no result.

    Texts are read once and never shuffled; digests are placed by range of
    (source, doc_id, digest, random number), so a source that holds most rows
    spans tasks.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "merkle")
    rows = slim(docs, doc_id="doc_id", source="source", lang="lang", n_chars="n_chars", text="text")
    row = {c: F.col(c) for c in rows.columns}
    lower = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    changed = F.when(tampered if tampered is not None else F.lit(False), leaf(row | {"text": lower}))
    leaves = scratch.table("leaves", rows.select("doc_id", F.col("source").cast("string").alias("source"), leaf(row).alias("h"), changed.alias("changed"), F.rand(12).alias("salt")))
    placed = numbered(leaves, ["source", "doc_id", "h", "salt"], "n")
    keys = scratch.table("keys", placed.groupBy("source").agg(F.min("n").alias("k"), F.count("*").alias("m")))
    count, most, size = keys.agg(F.count("*"), F.max("m"), F.sum(F.coalesce(F.octet_length("source"), F.lit(0)) + 48)).first()
    if not count:
        return leaves.select("doc_id", F.col("h").alias("leaf"), *(F.lit(None).cast("string").alias(c) for c in ("subroot", "root", "proof_sha256", "folded_root")), F.lit(False).alias("verified"))
    own = keys.withColumnRenamed("source", "s")
    own = F.broadcast(own) if size <= SMALL else own
    nodes = scratch.table("nodes", placed.join(own, F.col("source").eqNullSafe(F.col("s"))).select("k", (F.col("n") - F.col("k")).alias("i"), "h", "m", "doc_id", "changed"))
    scratch.drop("leaves")
    levels, subroots = grow(scratch, nodes.select("k", "i", "h", "m"), _height(most), "level")
    subs = scratch.table("subroots", numbered(subroots, ["k"], "n").select(F.lit(0).cast("bigint").alias("k"), (F.col("n") - 1).alias("i"), "h", F.lit(count).cast("bigint").alias("m"), F.col("k").alias("source_k")))
    upper, top = grow(scratch, subs.select("k", "i", "h", "m"), _height(count), "upper")
    top = top.select("k", F.array().cast(_PATH).alias("path"), F.lit(None).cast("string").alias("subroot"), F.col("h").alias("root"))
    tops = scratch.table("tops", descend(scratch, upper, top, subs, "source").select(F.col("source_k").alias("k"), "path", F.col("h").alias("subroot"), "root"))
    found = descend(scratch, levels, tops, nodes, "path")
    out = found.select("doc_id", F.col("h").alias("leaf"), "subroot", "root", digest(siblings(F.col("path"))).alias("proof_sha256"), fold(F.coalesce("changed", "h"), F.col("path")).alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


def every_fifth(doc_id: Column) -> Column:
    """Where 5 divides the checksum of the id's decimal digits; never for null."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))
