"""N-gram Jaccard join by parity sketches: documents that share three quarters of their word shingles."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratawork.llm.components import components
from stratawork.llm.shingles import column_bytes, set_key, shingle_sets
from stratawork.llm.sketches import BAND_BITS, JOINED_BLOCKS, SINGLE, bands, blocks, parities, sampled_least
from stratawork.llm.support import Scratch, if_small, slim

#: Documents that may share a block before it counts as hot and is not paired up.
HOT = 50
#: Hot blocks by which a document that has little else is held against their first document.
LEAD = 4
#: Documents in one side of a comparison of those that share a frequent shingle of their prefixes, and words of their bit sketches in it.
CELL, CELL_WORDS = 512, 64


def sketched(docs: DataFrame, joined: int | None = JOINED_BLOCKS) -> DataFrame:
    """(id, n, k1, k2, bands) of (id, text): the set's size, its 128-bit digest and, in each of its bands, its blocks and bits.

    One pass over the texts; a batch's sets are held at a time.
    """

    def run(batches):
        import pyarrow as pa

        kind = pa.list_(pa.struct([("band", pa.int32()), ("keys", pa.list_(pa.int64())), ("bits", pa.list_(pa.int64()))]))
        for b in batches:
            data, offsets = column_bytes(b.column(1))
            n, k1, k2, sk = [], [], [], []
            for s in shingle_sets(data, offsets):
                key = set_key(s) if len(s) else (0, 0)
                n.append(len(s))
                k1.append(key[0])
                k2.append(key[1])
                sk.append([{"band": k, "keys": blocks(s, k, joined).view(np.int64), "bits": parities(s, k)} for k in bands(len(s))])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(k1, pa.int64()), pa.array(k2, pa.int64()), pa.array(sk, kind)], names=["id", "n", "k1", "k2", "bands"])

    return docs.mapInArrow(run, "id bigint, n bigint, k1 bigint, k2 bigint, bands array<struct<band:int,keys:array<bigint>,bits:array<bigint>>>")


def hashed_sets(docs: DataFrame) -> DataFrame:
    """(id, s): the sorted shingle hashes of (id, text)."""

    def run(batches):
        import pyarrow as pa

        for b in batches:
            sets = [s.view(np.int64) for s in shingle_sets(*column_bytes(b.column(1)))]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sets, pa.list_(pa.int64()))], names=["id", "s"])

    return docs.mapInArrow(run, "id bigint, s array<bigint>")


def sets_of(docs: DataFrame, ids: DataFrame, repeated: bool) -> DataFrame:
    """(id, s) of the documents with these ids; if ids are ``repeated``, each set of an id once."""
    sets = hashed_sets(docs.join(ids, "id", "left_semi").select("id", "text"))
    return sets.dropDuplicates(["id", "s"]) if repeated else sets


def _apart(n: Column, m: Column) -> Column:
    """Shingles that are in one only of two linked sets of n and m, at most."""
    return F.floor((n + m) / 7)


def _needed(band: Column, n: Column, ne: Column, n2: Column, ne2: Column, joined: int | None) -> Column:
    """Equal blocks that two linked sets of n and n2 shingles and ne and ne2 blocks have at least.

    As many blocks differ as shingles at most. Blocks of one shingle count the
    intersection itself. Only if blocks were left out it is a number that a
    linked pair has but for odds under 1e-10.
    """
    proof = F.greatest(ne, ne2) - _apart(n, n2)
    if joined:
        proof = F.when(F.pow(F.lit(2), band) <= joined, proof).otherwise(F.lit(sampled_least(joined)))
    return F.when(F.pow(F.lit(2), band + 1) <= SINGLE, F.ceil(3 * (n + n2) / 7)).otherwise(proof).cast("bigint")


def _sized(a: Column, b: Column) -> Column:
    return 4 * F.least(a, b) >= 3 * F.greatest(a, b)


def _n(size: str) -> Column:
    return F.shiftright(F.col(size), 32)


def _ne(size: str) -> Column:
    return F.col(size).bitwiseAND(F.lit((1 << 32) - 1))


def links(scratch: Scratch, docs: DataFrame, reps: DataFrame, joined: int | None, repeated: bool = True) -> DataFrame:
    """Links (a, b) of the class representatives ``reps`` (id, n, bands) whose components are those of all links."""
    band = F.col("key").bitwiseAND(F.lit((1 << BAND_BITS) - 1)).cast("int").alias("band")
    rows = reps.select("id", "n", F.explode("bands.keys").alias("keys"))
    # a block row is three numbers: its key, whose low bits are the band, the document, and its counts of shingles and blocks
    rows = rows.select("id", F.shiftleft("n", 32).bitwiseOR(F.size("keys").cast("bigint")).alias("size"), F.explode("keys").alias("key"))
    shared = scratch.table("shared", rows.groupBy("key").agg(F.count("*").alias("c")).filter("c > 1"))
    scratch.sweep()
    members = scratch.table("members", rows.join(shared, "key").select("key", "id", "size", "c"))
    scratch.drop("shared")
    scratch.sweep()

    lead = F.slice(F.sort_array(F.collect_list("key")), 1, LEAD).alias("lead")  # of a document's own blocks
    hot = members.filter(F.col("c") > HOT).groupBy("id", band).agg(F.count("*").alias("h"), F.first("size").alias("size"), lead)
    # open documents could share nothing but hot blocks with a linked one
    fewest = _needed(F.col("band"), _n("size"), _ne("size"), F.least(F.floor(_n("size") * 4 / 3), F.pow(F.lit(2), F.col("band") + 1).cast("bigint") - 1), F.lit(0), joined)
    small = F.ceil(_n("size") * 3 / 4)  # of blocks of one shingle
    fewest = F.when(F.pow(F.lit(2), F.col("band") + 1) <= SINGLE, small).otherwise(fewest)
    hot = scratch.table("hot", hot.withColumn("open", F.col("h") >= fewest))
    # pairs of a block that few share; counted over all blocks of the pair
    groups = members.filter(F.col("c") <= HOT).groupBy("key").agg(F.sort_array(F.collect_list(F.struct("id", "size"))).alias("g"))  # HOT of them at most
    pairs = (
        groups.select(band, "g", F.posexplode("g").alias("i", "x"))
        .select("band", "x", F.explode(F.slice("g", F.col("i") + 2, F.size("g"))).alias("y"))
        .select("band", F.col("x.id").alias("a"), F.col("y.id").alias("b"), F.col("x.size").alias("sa"), F.col("y.size").alias("sb"))
        .filter(_sized(_n("sa"), _n("sb")) & (F.col("a") < F.col("b")))
        .groupBy("a", "b", "band")
        .agg(F.count("*").alias("eq"), F.first("sa").alias("sa"), F.first("sb").alias("sb"))
    )
    heat = lambda end: hot.select(F.col("id").alias(end), "band", F.col("h").alias(f"h{end}"), F.col("open").alias(f"open{end}"))
    pairs = pairs.join(heat("a"), ["a", "band"], "left").join(heat("b"), ["b", "band"], "left")
    most = F.least(F.coalesce("ha", F.lit(0)), F.coalesce("hb", F.lit(0)))
    # two open ones are left to what comes below
    pairs = pairs.filter(~(F.coalesce("opena", F.lit(False)) & F.coalesce("openb", F.lit(False))))
    found = pairs.filter(F.col("eq") + most >= _needed(F.col("band"), _n("sa"), _ne("sa"), _n("sb"), _ne("sb"), joined)).select("a", "b", "eq")

    # open ones: first each against the first of some of its blocks
    open_ = scratch.table("open", hot.filter("open").select("id", _n("size").alias("n"), "lead"))
    led = open_.select("id", "n", F.explode("lead").alias("key"))
    leaders = led.groupBy("key").agg(F.min(F.struct("id", "n")).alias("first"))
    first = led.join(leaders, "key").filter((F.col("id") > F.col("first.id")) & _sized(F.col("n"), F.col("first.n"))).select(F.col("first.id").alias("a"), F.col("id").alias("b"), F.lit(0).cast("bigint").alias("eq"))
    candidates = scratch.table("candidates", near(reps, found.union(first).groupBy("a", "b").agg(F.max("eq").alias("eq"))))
    scratch.drop("members", "hot")
    scratch.sweep()
    # then its nearest candidate for each document, and the others only where that left two components
    best = candidates.groupBy("b").agg(F.max(F.struct("eq", "a")).alias("x")).select(F.col("x.a").alias("a"), "b")
    verified = scratch.table("links", verify(scratch, docs, scratch.table("best", best), "sets", repeated))
    comp = components(scratch, verified, "near")
    pairs = None
    if open_.limit(1).count():
        ids = scratch.table("open-ids", open_.select("id").distinct())
        bits = scratch.table("open-reps", reps.join(if_small(ids)[0], "id", "left_semi"))
        prefix = prefixes(scratch, docs, ids, repeated)
        held = busy(scratch, prefix, comp, "busy1").filter(F.col("c") > HOT)
        first = scratch.table("firsts", held.groupBy("t").agg(F.min(F.struct("id", "n", "component")).alias("x")))
        led = held.join(first, "t").filter((F.col("x.component") != F.col("component")) & _sized(F.col("n"), F.col("x.n")))
        led = scratch.table("led", near(bits, led.select(F.least("id", "x.id").alias("a"), F.greatest("id", "x.id").alias("b")).distinct()))
        verified = verified.union(scratch.table("links1", verify(scratch, docs, led, "sets1", repeated)))
        comp = components(scratch, verified, "nearer")
        pairs = near(bits, late(scratch, bits, prefix, comp))
    rest = apart(candidates.select("a", "b"), comp)
    rest = scratch.table("rest", rest.union(pairs).distinct() if pairs is not None else rest)
    verified = verified.union(scratch.table("links2", verify(scratch, docs, rest, "sets2", repeated)))
    scratch.drop("candidates", "best", "led", "rest", "open", "open-ids", "open-reps", "open-sets", "prefixes", "firsts", *(f"busy{k}{e}" for k in (1, 2) for e in ("", "-rows", "-held")), *(f"{k}{e}" for k in ("sets", "sets1", "sets2") for e in ("", "-ends")))
    return verified


def apart(pairs: DataFrame, comp: DataFrame) -> DataFrame:
    """The pairs whose ends ``comp`` (id, component) has in different components."""
    of = lambda end: comp.select(F.col("id").alias(end), F.col("component").alias(f"c{end}"))
    return pairs.join(of("a"), "a", "left").join(of("b"), "b", "left").filter(F.coalesce("ca", "a") != F.coalesce("cb", "b")).select("a", "b", *pairs.columns[2:])


def near(reps: DataFrame, pairs: DataFrame) -> DataFrame:
    """The pairs (a, b, and more) that are not proven too far apart by the Hamming distance of their bit sketches.

    The sketches of the least band that both have are compared; two sets that
    have none in common differ too much in size.
    """
    bits = reps.select("id", "n", F.explode("bands").alias("x")).select("id", "n", F.col("x.band").alias("band"), F.col("x.bits").alias("bits"))
    of = lambda end: bits.select(F.col("id").alias(end), F.col("n").alias(f"n{end}"), "band", F.col("bits").alias(f"bits{end}"))
    # shuffled on purpose: pairs of numbers look small to the planner as they are compressed, and a table of them in memory is not
    both = pairs.join(of("a").hint("merge"), "a").join(of("b").hint("merge"), ["b", "band"])
    distance = F.aggregate(F.zip_with("bitsa", "bitsb", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, x: s + x)
    kept = both.filter(_sized(F.col("na"), F.col("nb")) & (distance <= _apart(F.col("na"), F.col("nb"))))
    rest = pairs.columns[2:]
    return kept.groupBy("a", "b").agg(*(F.max(c).alias(c) for c in rest)) if rest else kept.select("a", "b").distinct()


def verify(scratch: Scratch, docs: DataFrame, pairs: DataFrame, name: str, repeated: bool = True) -> DataFrame:
    """The pairs whose sets have 100 * intersection >= 75 * union, counted exactly on the whole sets, each set of an id once."""
    ends, _ = if_small(scratch.table(f"{name}-ends", pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct()))
    sets = scratch.table(name, sets_of(docs, ends, repeated))
    out = sets.select(F.col("id").alias("a"), F.col("s").alias("sa")).join(pairs, "a").join(sets.select(F.col("id").alias("b"), F.col("s").alias("sb")), "b")
    both = F.size(F.array_intersect("sa", "sb"))
    out = out.select("a", "b", both.alias("i"), (F.size("sa") + F.size("sb")).alias("t"))
    return out.filter(100 * F.col("i") >= 75 * (F.col("t") - F.col("i"))).select("a", "b")


def prefixes(scratch: Scratch, docs: DataFrame, open_: DataFrame, repeated: bool = True) -> DataFrame:
    """(t, id, n): of each open document (id) the shingles t by which prefix filtering finds all that it links with among them.

    Their shingles are put in one order, those first that fewest of them hold.
    Two linked sets share one of the first n - ceil(0.75 n) + 1 of each; every
    set of a repeated id has its own.
    """
    ends, _ = if_small(open_)
    sets = scratch.table("open-sets", sets_of(docs, ends, repeated))
    own = [F.xxhash64("s").alias("h")] if repeated else []
    each = sets.select("id", F.size("s").cast("bigint").alias("n"), *own, F.explode("s").alias("t"))
    often = each.groupBy("t").agg(F.count("*").alias("f"))
    ranked = each.join(often, "t").groupBy("id", "n", *(["h"] if repeated else [])).agg(F.sort_array(F.collect_list(F.struct("f", "t"))).alias("r"))  # a document's own shingles
    prefix = ranked.select("id", "n", F.explode(F.slice("r", 1, (F.col("n") - F.ceil(F.col("n") * 3 / 4) + 1).cast("int"))).alias("x")).filter("x.f > 1")
    return scratch.table("prefixes", prefix.select(F.col("x.t").alias("t"), "id", "n").distinct())


def busy(scratch: Scratch, prefix: DataFrame, comp: DataFrame, name: str) -> DataFrame:
    """``prefix`` with the component of each document, and the number c of documents, for shingles whose holders are not of one component already.

    What is counted is a table of its own: the join of a shingle that very
    many documents hold is then a plain one, whose hot partitions are split.
    """
    rows = scratch.table(f"{name}-rows", prefix.join(comp, "id", "left").select("t", "id", "n", F.coalesce("component", "id").alias("component")))
    held = rows.groupBy("t").agg(F.count("*").alias("c"), F.min("component").alias("lo"), F.max("component").alias("hi")).filter("lo < hi").select("t", "c")
    return scratch.table(name, rows.join(scratch.table(f"{name}-held", held), "t"))


def late(scratch: Scratch, reps: DataFrame, prefix: DataFrame, comp: DataFrame) -> DataFrame:
    """Pairs (a, b) of open documents of different components, all linked ones among them.

    Holders of a shingle that few share are paired up, those of others are
    compared in cells.
    """
    rows = busy(scratch, prefix, comp, "busy2")
    groups = rows.filter(F.col("c") <= HOT).groupBy("t").agg(F.sort_array(F.collect_list(F.struct("id", "n", "component"))).alias("g"))  # HOT of them at most
    few = groups.select("g", F.posexplode("g").alias("i", "x")).select("x", F.explode(F.slice("g", F.col("i") + 2, F.size("g"))).alias("y"))
    few = few.filter((F.col("x.component") != F.col("y.component")) & (F.col("x.id") < F.col("y.id")) & _sized(F.col("x.n"), F.col("y.n"))).select(F.col("x.id").alias("a"), F.col("y.id").alias("b"))
    return few.union(in_cells(rows.filter(F.col("c") > HOT), reps)).distinct()


def in_cells(rows: DataFrame, reps: DataFrame) -> DataFrame:
    """Pairs (a, b) of ``rows`` (t, id, n, component, c) that share t, differ in component and are near enough by their bit sketches.

    The c holders of a t are dealt to cells of about CELL by hash, and each two
    cells are compared in a task of their own, so that memory follows the cell
    and only near pairs leave it.
    """
    bits = reps.select("id", "n", F.explode("bands").alias("x")).select("id", "n", F.col("x.band").alias("band"), F.col("x.bits").alias("bits"))
    cells = F.ceil(F.col("c") / CELL).cast("int")
    rows = rows.withColumn("cell", F.pmod(F.xxhash64("id"), cells).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), cells - 1)))
    rows = rows.select("t", "id", "n", "component", "cell", F.least("cell", "other").alias("lo"), F.greatest("cell", "other").alias("hi")).join(bits.hint("merge"), ["id", "n"])

    def run(key, table):
        import pyarrow as pa

        lo, hi = key[2].as_py(), key[3].as_py()
        ids, n, c, cell = (np.array(table.column(k).to_pylist(), np.int64) for k in ("id", "n", "component", "cell"))
        x, y = np.flatnonzero(cell == lo), np.flatnonzero(cell == hi)
        if len(np.unique(c)) > 1:
            w = np.array(table.column("bits").to_pylist(), np.int64).view(np.uint64).reshape(len(ids), -1)
            while w.shape[1] > CELL_WORDS:  # halves upon each other are the sketch of half the bits
                w = w[:, : w.shape[1] // 2] ^ w[:, w.shape[1] // 2 :]
            total = n[x][:, None] + n[y][None, :]
            near = (4 * np.minimum(n[x][:, None], n[y][None, :]) >= 3 * np.maximum(n[x][:, None], n[y][None, :])) & (c[x][:, None] != c[y][None, :])
            distance = np.zeros(total.shape, np.int32)
            for k in range(w.shape[1]):
                distance += np.bitwise_count(w[x, k][:, None] ^ w[y, k][None, :])
            i, j = np.nonzero(near & (distance <= total // 7))
            x, y = ids[x][i], ids[y][j]
            if lo == hi:
                x, y = x[x < y], y[x < y]
        else:
            x = y = ids[:0]
        return pa.table({"a": pa.array(np.minimum(x, y), pa.int64()), "b": pa.array(np.maximum(x, y), pa.int64())})

    return rows.groupBy("t", "band", "lo", "hi").applyInArrow(run, "a bigint, b bigint")


def jaccard_components(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", joined: int | None = JOINED_BLOCKS) -> DataFrame:
    """(id, n_shingles, component_id) of every document, whole texts throughout.

    Documents link when 100 * |intersection| >= 75 * |union| of their distinct
    5-word shingles (fewer words: all of them as one). Null, empty and
    word-less texts have 0 shingles and link with nothing. Equal sets are one
    class under its smallest id and links are sought between classes only;
    component_id is the smallest id reachable. A repeated id is one node, each
    of its rows is returned. A null id links with nothing and has no component.

    ``joined`` is a power of two: of sketches with more blocks so many are
    joined, which misses a pair with odds under 1e-10. With None all blocks of
    every sketch are, and the pigeonhole argument is a proof at every size.
    """
    if joined and sampled_least(joined) < 1:
        raise ValueError(f"{joined} blocks are too few to find pairs by")
    scratch = Scratch(df.sparkSession, "jaccard")
    docs = slim(df, id=id_col, text=text_col).withColumn("id", F.col("id").cast("bigint"))
    sk = scratch.table("sketches", sketched(docs, joined))
    own = scratch.table("own", sk.select("id", "n", "k1", "k2"))
    classes = scratch.table("classes", own.filter("n > 0 and id is not null").groupBy("n", "k1", "k2").agg(F.min("id").alias("rep")))
    first = classes.select(F.col("rep").alias("id"), "n", "k1", "k2")
    reps = sk.join(first, ["id", "n", "k1", "k2"], "left_semi").dropDuplicates(["id", "n", "k1", "k2"])  # a repeated id may have several sets
    reps = scratch.table("reps", reps.select("id", "n", "bands"))
    scratch.drop("sketches")
    scratch.sweep()
    repeated = not own.filter("n > 0 and id is not null").groupBy("id").count().filter("count > 1").isEmpty()
    found = links(scratch, docs, reps, joined, repeated)
    comp = components(scratch, found, "all")
    reached = scratch.table("reached", classes.join(comp, classes["rep"] == comp["id"], "left").select("n", "k1", "k2", F.coalesce("component", "rep").alias("component_id")))
    scratch.drop("classes", "reps", "links", "links1", "links2")
    scratch.sweep()
    out = own.join(reached, ["n", "k1", "k2"], "left")
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.when(F.col("id").isNotNull(), F.coalesce("component_id", "id")).alias("component_id"))
