"""Joins with the semantics of reference checks, lookups, containment, intervals and nearest vectors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stratawork.functions.columns import ancestors
from stratawork.session import written


def orphan_status(df: DataFrame, keys: DataFrame, key: str, otherwise: Column) -> DataFrame:
    """``df`` with status pending_orphan where a non-blank key is not among ``keys``."""
    known = keys.select(F.col(key).alias("__known")).distinct()
    j = df.join(known, df[key] == F.col("__known"), "left")
    orphan = F.col(key).isNotNull() & (F.trim(F.col(key).cast("string")) != "") & F.col("__known").isNull()
    return j.withColumn("status", F.when(orphan, "pending_orphan").otherwise(otherwise)).drop("__known")


def reconcile(left: DataFrame, right: DataFrame, key: str, n_left: str, n_right: str) -> DataFrame:
    """Keys whose counts differ: the left's default is 0, a missing or null right does not count."""
    j = left.join(right, key, "full").withColumn(n_left, F.coalesce(n_left, F.lit(0)))
    return j.filter(F.col(n_right).isNotNull() & (F.col(n_left) != F.col(n_right))).select(key, n_left, n_right, (F.col(n_left) - F.col(n_right)).alias("delta"))


def exclude_paths(df: DataFrame, path: str, excluded: DataFrame) -> DataFrame:
    """Rows whose path is neither excluded nor below an excluded one, case aside.

    Every prefix of a path is looked up, an equi join, instead of comparing
    paths with all exclusions.
    """
    ex = excluded.select(F.lower(F.col("path")).alias("__p")).filter("__p <> ''").distinct()
    hit = df.select(path, F.explode(ancestors(F.lower(F.col(path)))).alias("__p")).join(ex, "__p", "left_semi").select(path).distinct()
    return df.join(hit, path, "left_anti")


def contained(df: DataFrame, text: str, words: list[str]) -> Column:
    """The words, in their order, that the text holds, case aside; the list is a configuration of bounded size."""
    low = F.lower(F.coalesce(F.col(text), F.lit("")))
    return F.filter(F.array(*map(F.lit, words)), lambda k: low.contains(F.lower(k)))


def containment_join(texts: DataFrame, key: str, text: str, aliases: DataFrame, alias: str, entity: str, few: int = 20_000, size: int = 8 << 20, gram: int = 4) -> DataFrame:
    """(key, entity) for every alias that a text holds as a substring, case aside.

    A table of aliases that is counted to be small, in rows and in characters,
    goes into one automaton, which passes over each text once. A larger one is
    joined, whatever its aliases look like: each stands under that of its
    ``gram`` characters in a row (all of it, if it is shorter) that the fewest
    texts hold, which every text that holds the alias has among its own, and
    what meets so is checked in full. Aliases with grams that no text holds
    are gone before that. Nothing but counts comes to the driver.
    """
    a = aliases.select(F.col(entity).alias("__e"), F.regexp_replace(F.lower(F.col(alias)), r"^\s+|\s+$", "").alias("__a")).filter("__a <> ''").distinct()
    t = texts.select(F.col(key), F.lower(F.coalesce(F.col(text), F.lit(""))).alias("__t"))
    n, long = a.limit(few + 1).agg(F.count("*"), F.sum(F.length("__a"))).first()
    if n <= few and (long or 0) <= size:
        return _by_automaton(t, key, a, entity)
    a = written(a.sparkSession, a, "aliases")
    sizes = sorted(r[0] for r in a.select(F.least(F.length("__a"), F.lit(gram))).distinct().collect())  # at most ``gram`` numbers
    held = written(t.sparkSession, _grams(t, key, "__t", sizes, None), "grams")
    common = held.groupBy("__g").agg(F.count("*").alias("__n"))
    own = _grams(a.select("__a").distinct(), "__a", "__a", sizes, gram).join(common, "__g", "left").withColumn("__n", F.coalesce("__n", F.lit(0)))
    rare = own.groupBy("__a").agg(F.min(F.struct("__n", "__g")).alias("__r")).filter("__r.__n > 0").select("__a", F.col("__r.__g").alias("__g"))
    near = held.join(written(t.sparkSession, rare, "rare"), "__g").select(key, "__a")
    hits = near.join(t, key).filter(F.contains("__t", "__a")).select(key, "__a")
    return hits.join(a, "__a").select(key, F.col("__e").alias(entity)).distinct()


def _grams(df: DataFrame, key: str, text: str, sizes: list[int], own: int | None) -> DataFrame:
    """(key, __g): the different runs of so many characters of each text; with ``own``, only the runs of its own size, which is ``own`` or all of a shorter one."""
    kind = df.schema[key].dataType.simpleString()

    def run(batches):
        import pyarrow as pa

        for b in batches:
            for k, body in enumerate(b.column(1).to_pylist()):
                wanted = sizes if own is None else [min(own, len(body))]
                found = sorted({body[i : i + n] for n in wanted for i in range(len(body) - n + 1)})
                yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array([k] * len(found), pa.int64())), pa.array(found, pa.string())], names=[key, "__g"])

    return df.select(F.col(key), F.col(text).alias("__body")).mapInArrow(run, f"`{key}` {kind}, __g string")


def _by_automaton(t: DataFrame, key: str, a: DataFrame, entity: str) -> DataFrame:
    """The aliases of a bounded table in each text, by one pass of an automaton over it."""
    kinds = {f.name: f.dataType.simpleString() for f in (*t.schema, *a.schema)}
    table: dict[str, list] = {}
    for r in a.collect():  # bounded by the caller
        table.setdefault(r["__a"], []).append(r["__e"])
    shared = t.sparkSession.sparkContext.broadcast(table)

    def run(batches):
        import ahocorasick
        import pyarrow as pa

        machine = ahocorasick.Automaton()
        for word, entities in shared.value.items():
            machine.add_word(word, entities)
        machine.make_automaton()
        for b in batches:
            at, hits = [], []
            for k, body in enumerate(b.column(1).to_pylist()):
                found = {e for _, entities in machine.iter(body) for e in entities} if shared.value else ()
                at += [k] * len(found)
                hits += sorted(found)
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(at, pa.int64())), pa.array(hits, b_type)], names=[key, entity])

    from pyspark.sql.pandas.types import to_arrow_type

    b_type = to_arrow_type(a.schema["__e"].dataType)
    return t.mapInArrow(run, f"`{key}` {kinds[key]}, `{entity}` {kinds['__e']}")


def dyadic(first: Column, last: Column) -> Column:
    """array<struct<level, node>>: the cells ``first`` to ``last`` as runs of 2**level cells that start at node * 2**level; two a level at most, none overlap."""

    def at(k: Column) -> Column:
        up = F.lit(1).cast("bigint") * F.pow(F.lit(2), k).cast("bigint")
        lo, hi = F.floor((first + up - 1) / up).cast("bigint"), F.floor((last + 1) / up).cast("bigint")
        odd = lambda x: F.pmod(x, F.lit(2)) == 1
        node = lambda ok, x: F.when((lo < hi) & ok, F.struct(k.alias("level"), x.alias("node")))
        return F.array(node(odd(lo), lo), node(odd(hi), hi - 1))

    return F.filter(F.flatten(F.transform(F.sequence(F.lit(0), F.ceil(F.log2(F.greatest(last - first + 1, F.lit(1)))).cast("int") + 1), at)), lambda x: x.isNotNull())


def overlapping(df: DataFrame, key: str, start: str, end: str, other: str, width: float, within: list[str] = (), empty: bool = False) -> DataFrame:
    """Pairs (key, key2) of intervals that overlap and differ in ``other``; ends are open.

    An interval that does not end after it starts has no pairs; with ``empty`` it
    has those that start before its end and end after its start, and so hold it.

    Of two that overlap, the one that starts later starts inside the other.
    Time is cut into cells of ``width``; an interval becomes the few dyadic
    runs of cells that it is made of, as many as the logarithm of its length,
    and a start the runs that hold its cell, one a level in use. These are
    joined, and as the runs of an interval do not overlap, a pair is found once.
    """
    cell = lambda c: F.floor(F.col(c) / width).cast("bigint")
    rows = df.filter(F.col(start).isNotNull() & F.col(end).isNotNull() if empty else F.col(start) < F.col(end)).select(F.col(key).alias("k"), F.col(start).alias("s"), F.col(end).alias("e"), F.col(other).alias("o"), cell(start).alias("c"), cell(end).alias("z"), *(F.col(c).alias(f"w{i}") for i, c in enumerate(within)))
    x = rows.filter("s < e").withColumn("x", F.explode(dyadic(F.col("c"), F.col("z")))).select(*rows.columns, "x.*")
    levels = [r[0] for r in x.select("level").distinct().collect()]  # 64 at most
    if not levels:
        return df.select(F.col(key), F.col(key).alias(f"{key}2")).limit(0)
    y = rows.withColumn("level", F.explode(F.array(*map(F.lit, sorted(levels))))).withColumn("node", F.floor(F.col("c") / F.pow(F.lit(2), F.col("level")).cast("bigint")).cast("bigint"))
    x, y = x.alias("x"), y.alias("y")
    on = (F.col("x.level") == F.col("y.level")) & (F.col("x.node") == F.col("y.node")) & (F.col("x.o") != F.col("y.o"))
    for i in range(len(within)):
        on = on & (F.col(f"x.w{i}") == F.col(f"y.w{i}"))
    later = (F.col("y.s") > F.col("x.s")) | ((F.col("y.s") == F.col("x.s")) & (F.col("y.k") > F.col("x.k")))
    pairs = x.join(y, on & later & (F.col("y.s") < F.col("x.e")) & (F.col("x.s") < F.col("y.e"))).select(F.col("x.k").alias("a"), F.col("y.k").alias("b")).filter("a <> b")
    return pairs.select(F.least("a", "b").alias(key), F.greatest("a", "b").alias(f"{key}2"))


def last_contained(outer: DataFrame, inner: DataFrame, group: str, width: float) -> DataFrame:
    """The last interval of ``inner`` (id, start, end) inside each of ``outer`` (oid, ostart, oend) of the same group."""
    i = inner.withColumn("__b", F.floor(F.col("start") / width))
    o = outer.withColumn("__b", F.explode(F.sequence(F.floor(F.col("ostart") / width), F.floor(F.col("oend") / width))))
    j = o.join(i, ["__b", group]).filter("start >= ostart and `end` <= oend")
    return j.groupBy("oid").agg(F.max(F.struct("start", "id")).alias("m")).select("oid", F.col("m.id").alias("last_id"))


def nearest_profile(df: DataFrame, key: str, vector: str, profiles: DataFrame, threshold: float, block: int = 20_000) -> DataFrame:
    """(key, profile, similarity) of the most similar profile above the threshold, ties to the first, else Unknown.

    Profiles (profile, ordinal, pv) are counted: up to ``block`` of them go
    out as one matrix, by which batches of vectors are multiplied; a larger
    registry is dealt to blocks of that size, a pass each, and the maxima of
    the blocks are one aggregate by key.
    """
    parts = max(1, -(-profiles.count() // block))
    dealt = F.pmod(F.xxhash64("profile", "ordinal"), F.lit(parts))
    found = [_nearest_of(df, key, vector, profiles if parts == 1 else profiles.filter(dealt == i), threshold) for i in range(parts)]
    best = found[0]
    for f in found[1:]:
        best = best.union(f)
    if parts > 1:
        top = F.max(F.when(F.col("profile").isNotNull(), F.struct("similarity", (-F.col("ordinal")).alias("o"), "profile")))
        best = best.groupBy(key).agg(top.alias("b")).select(key, "b.profile", "b.similarity")
    return best.select(key, F.coalesce("profile", F.lit("Unknown")).alias("profile"), F.coalesce("similarity", F.lit(0.0)).alias("similarity"))


def _nearest_of(df: DataFrame, key: str, vector: str, profiles: DataFrame, threshold: float) -> DataFrame:
    """(key, profile, ordinal, similarity) by one matrix of profiles; nulls where none is near enough."""
    rows = profiles.select("ordinal", F.col("profile").cast("string").alias("profile"), F.col("pv").cast("array<double>").alias("pv")).filter("pv is not null").orderBy("ordinal", "profile").collect()  # a block
    shared = df.sparkSession.sparkContext.broadcast([(int(r["ordinal"]), r["profile"], r["pv"]) for r in rows])

    def run(batches):
        import numpy as np
        import pyarrow as pa

        held = shared.value
        by_size: dict[int, tuple] = {}
        for size in {len(pv) for _, _, pv in held}:
            some = [h for h in held if len(h[2]) == size]
            m = np.array([h[2] for h in some], float).reshape(len(some), size)
            by_size[size] = (some, m, np.sqrt((m * m).sum(1)))
        for b in batches:
            names, ordinals, sims = [None] * len(b), [None] * len(b), [None] * len(b)
            vectors = b.column(1).to_pylist()
            for size, (some, m, norms) in by_size.items():
                at = [k for k, v in enumerate(vectors) if v is not None and len(v) == size and None not in v]
                if not at:
                    continue
                x = np.array([vectors[k] for k in at], float).reshape(len(at), size)
                both = np.sqrt((x * x).sum(1))[:, None] * norms[None, :]
                s = np.where(both > 0, (x @ m.T) / np.where(both > 0, both, 1), 0.0).round(12)  # equal profiles are equal, whatever the order of a sum
                top = s.argmax(1)
                for k, t, v in zip(at, top.tolist(), s[np.arange(len(at)), top].tolist(), strict=True):
                    if v >= threshold - 1e-9:
                        ordinals[k], names[k], sims[k] = some[t][0], some[t][1], v
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(names, pa.string()), pa.array(ordinals, pa.int64()), pa.array(sims, pa.float64())], names=[key, "profile", "ordinal", "similarity"])

    kind = df.schema[key].dataType.simpleString()
    rows = df.select(F.col(key), F.col(vector).cast("array<double>").alias("__v"))
    return rows.mapInArrow(run, f"`{key}` {kind}, profile string, ordinal bigint, similarity double")


def band_of(score: Column, bands: list[tuple[str, int]], default: str = "Skip") -> Column:
    """The first band, from the top, whose least score is reached."""
    case = None
    for name, least in sorted(bands, key=lambda b: -b[1]):
        case = F.when(score >= least, name) if case is None else case.when(score >= least, name)
    return case.otherwise(default) if case is not None else F.lit(default)


def text_join(df: DataFrame, key: str, kind: str, value: str, kinds: list[str], sep: str = "; ") -> DataFrame:
    """A row a key with the values of each kind joined in order."""
    wide = df.groupBy(key).pivot(kind, kinds).agg(F.array_join(F.array_sort(F.collect_list(value)), sep))
    return wide.na.fill("", kinds)


def best_of(df: DataFrame, keys: list[str], order: list[Column], n: int = 1) -> DataFrame:
    return df.withColumn("__rn", F.row_number().over(W.partitionBy(*keys).orderBy(*order))).filter(F.col("__rn") <= n).drop("__rn")
