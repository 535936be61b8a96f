"""Near-duplicate vectors by product quantisation: inverted lists, residual codes, exact rerank."""

from __future__ import annotations


import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratawork.llm.components import components
from stratawork.llm.support import Scratch, slim

THRESHOLD = 0.93
#: Vectors that the index is fitted on (about: a hash picks them), and lists that a vector is sought in.
SAMPLE, PROBES = 20_000, 8
#: Vectors of the largest label in a list, about, and centroids of one level of the lists at most.
LIST, LEVEL = 128, 4096
#: Width of a subspace, codes in one, vectors in one side of a comparison.
SUBSPACE, CODES, CELL = 8, 256, 512
#: Rows up to which the table of list sizes is broadcast.
SMALL = 200_000


def _kmeans(x: np.ndarray, k: int, rounds: int, rng: np.random.Generator) -> np.ndarray:
    c = x[rng.choice(len(x), k, replace=False)].copy()
    for _ in range(rounds):
        near = _nearest(x, c)
        total = np.zeros_like(c)
        np.add.at(total, near, x)
        count = np.bincount(near, minlength=k)
        c[count > 0] = total[count > 0] / count[count > 0, None]
    return c


def _squares(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return np.maximum(0, (x * x).sum(1)[:, None] - 2 * x @ c.T + (c * c).sum(1)[None, :])


def _nearest(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return np.concatenate([_squares(x[i : i + 4096], c).argmin(1) for i in range(0, len(x), 4096)]) if len(x) else np.zeros(0, np.int64)


def levels(lists: int) -> tuple[int, int]:
    """Centroids of the coarse level and of that of its residuals for about so many lists: one level is enough for few."""
    lists = max(1, lists)
    if lists <= 1024:
        return lists, 1
    first = min(LEVEL, round(lists**0.5))
    return first, min(LEVEL, -(-lists // first))


class Index:
    """Inverted lists in two levels and, of the residuals, one codebook a subspace; fitted on a bounded sample of unit vectors.

    A list is a coarse centroid and a centroid of what it leaves, so lists can
    grow with the table, up to LEVEL squared, while the sample does not.
    """

    def __init__(self, sample: np.ndarray, lists: int, seed: int = 5):
        rng = np.random.default_rng(seed)
        dim = sample.shape[1]
        first, second = (min(k, len(sample)) for k in levels(lists))
        self.coarse = _kmeans(sample, first, 8, rng)
        rest = sample - self.coarse[_nearest(sample, self.coarse)]
        self.fine = _kmeans(rest, second, 6, rng) if second > 1 else np.zeros((1, dim))
        rest -= self.fine[_nearest(rest, self.fine)]
        self.cuts = [(a, min(dim, a + SUBSPACE)) for a in range(0, dim, SUBSPACE)]
        self.books = [_kmeans(rest[:, a:b], min(CODES, len(sample)), 6, rng) for a, b in self.cuts]

    def centre(self, at: np.ndarray) -> np.ndarray:
        return self.coarse[at // len(self.fine)] + self.fine[at % len(self.fine)]

    def lists(self, x: np.ndarray) -> np.ndarray:
        """The list of each vector."""
        a = _nearest(x, self.coarse)
        return a * len(self.fine) + _nearest(x - self.coarse[a], self.fine)

    def encode(self, x: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes of the residuals, and how far each vector is from what its code says."""
        rest = x - self.centre(at)
        codes = np.stack([_nearest(rest[:, a:b], book) for (a, b), book in zip(self.cuts, self.books, strict=True)], axis=1)
        said = np.concatenate([book[codes[:, m]] for m, book in enumerate(self.books)], axis=1)
        return codes.astype(np.uint8), np.sqrt(((rest - said) ** 2).sum(1))

    @staticmethod
    def _within(x: np.ndarray, centres: np.ndarray, most: int | None, radius: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The centroids nearest to each vector, their squared distances, and whether their cells come within ``radius`` of it."""
        d = _squares(x, centres)
        near = np.argsort(d, axis=1, kind="stable")[:, :most]
        dn = np.take_along_axis(d, near, 1)
        apart = np.sqrt(np.maximum(0, ((centres[near] - centres[near[:, :1]]) ** 2).sum(2)))
        return near, dn, dn - dn[:, :1] <= 2 * radius * apart + 1e-9  # the distance to the plane between the two cells

    def probes(self, x: np.ndarray, most: int | None, radius: float) -> list[np.ndarray]:
        """The lists whose cell comes within ``radius`` of each vector, its own first; the ``most`` nearest of them, or all."""
        out, own = [], self.lists(x)
        for i in range(0, len(x), 256):
            part = x[i : i + 256]
            near, dn, ok = self._within(part, self.coarse, most, radius)
            found, far = [], []
            for m in range(near.shape[1]):
                if len(self.fine) == 1:
                    found.append(np.where(ok[:, m : m + 1], near[:, m : m + 1], -1))
                    far.append(dn[:, m : m + 1])
                else:
                    rest = part - self.coarse[near[:, m]]
                    n2, d2, ok2 = self._within(rest, self.fine, most, radius)
                    found.append(np.where(ok2 & ok[:, m : m + 1], near[:, m : m + 1] * len(self.fine) + n2, -1))
                    far.append(d2)
            found, far = np.concatenate(found, 1), np.concatenate(far, 1)
            far[(found < 0)] = np.inf
            far[found == own[i : i + 256, None]] = -1
            order = np.argsort(far, axis=1, kind="stable")[:, :most]
            found, far = np.take_along_axis(found, order, 1), np.take_along_axis(far, order, 1)
            out += [f[k].astype(np.int32) for f, k in zip(found, np.isfinite(far), strict=True)]
        return out

    def tables(self, x: np.ndarray, at: int) -> np.ndarray:
        """Squared distances of each query's residual to every code, a table a subspace."""
        rest = x - self.centre(np.array([at]))
        out = np.zeros((len(self.books), len(x), CODES))
        for m, ((a, b), book) in enumerate(zip(self.cuts, self.books, strict=True)):
            out[m, :, : len(book)] = _squares(rest[:, a:b], book)
        return out


def _matrix(column, dim: int) -> np.ndarray:
    """Unit vectors in double precision, filled up with zeros to ``dim``."""
    import pyarrow as pa

    c = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    sizes = np.asarray(c.value_lengths())
    flat = np.asarray(c.flatten(), np.float64)
    x = np.zeros((len(c), dim))
    x[np.arange(dim)[None, :] < sizes[:, None]] = flat
    x /= np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(1))[:, None]


def linked(scratch: Scratch, reps: DataFrame, threshold: float, most: int | None) -> DataFrame:
    """(id, add, root): of each comparison the links that a vector gained, copies counted, and the smallest id of its group in it."""
    spark = reps.sparkSession
    n, dim = reps.agg(F.count("*"), F.max(F.size("v"))).first()
    empty = spark.createDataFrame([], "id bigint, add bigint, root bigint")
    if n < 2:
        return empty
    share = min(1.0, SAMPLE / n)
    picked = reps.filter(F.pmod(F.xxhash64("id"), F.lit(1 << 30)) < int(share * (1 << 30))).select("id", "v").toArrow().sort_by("id")
    if not picked.num_rows:
        picked = reps.orderBy("id").limit(256).select("id", "v").toArrow()
    largest = reps.groupBy("label").count().agg(F.max("count")).first()[0]
    index = Index(_matrix(picked.column("v"), dim), -(-largest // LIST))  # lists grow with the table, so that a vector meets as many others at any size
    vector = reps.schema["v"].dataType.simpleString()
    radius = float(np.sqrt(2 - 2 * threshold))

    def place(batches):
        import pyarrow as pa

        for b in batches:
            if not b.num_rows:
                continue
            x = _matrix(b.column("v"), dim)
            probes = index.probes(x, most, radius)
            at = np.array([p[0] for p in probes], np.int32)
            codes, off = index.encode(x, at)
            yield pa.RecordBatch.from_arrays(
                [*(b.column(c) for c in ("id", "copies", "label", "v")), pa.array(at), pa.array(probes, pa.list_(pa.int32())), pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(off)],
                names=["id", "copies", "label", "v", "list", "probes", "code", "off"],
            )

    schema = f"id bigint, copies bigint, label string, v {vector}, list int, probes array<int>, code binary, off double"
    placed = scratch.table("placed", reps.select("id", "copies", "label", "v").mapInArrow(place, schema)).withColumn("dim", F.size("v"))
    key = ["label", "dim", "list"]
    asked = placed.select("label", "dim", F.explode("probes").alias("list")).groupBy(key).agg(F.count("*").alias("q"))
    sizes = scratch.table("sizes", placed.groupBy(key).agg(F.count("*").alias("m")).join(asked, key).select(*key, F.ceil(F.col("m") / CELL).cast("int").alias("mc"), F.ceil(F.col("q") / CELL).cast("int").alias("qc")))
    if sizes.count() <= SMALL:
        sizes = F.broadcast(sizes)
    member = placed.join(sizes, key).withColumn("mcell", F.pmod(F.xxhash64("id"), F.col("mc")).cast("int")).withColumn("qcell", F.explode(F.sequence(F.lit(0), F.col("qc") - 1))).withColumn("asks", F.lit(False)).withColumn("own", F.col("list"))
    query = placed.withColumn("own", F.col("list")).withColumn("list", F.explode("probes")).withColumn("code", F.lit(None).cast("binary")).join(sizes, key)
    query = query.withColumn("qcell", F.pmod(F.xxhash64("id"), F.col("qc")).cast("int")).withColumn("mcell", F.explode(F.sequence(F.lit(0), F.col("mc") - 1))).withColumn("asks", F.lit(True))
    columns = ["label", "dim", "list", "mcell", "qcell", "asks", "id", "copies", "v", "own", "probes", "code", "off"]

    def compare(key, t):
        import pyarrow as pa
        import pyarrow.compute as pc

        at = key[2].as_py()
        y, x = t.filter(pc.invert(t.column("asks"))), t.filter(t.column("asks"))
        found: dict[int, int] = {}
        add: dict[int, int] = {}
        if y.num_rows and x.num_rows:
            xv, yv = _matrix(x.column("v"), dim), _matrix(y.column("v"), dim)
            codes = np.frombuffer(b"".join(y.column("code").to_pylist()), np.uint8).reshape(y.num_rows, -1)
            table = index.tables(xv, at)
            near = table[0][:, codes[:, 0]]
            for m in range(1, codes.shape[1]):
                near += table[m][:, codes[:, m]]
            # |x - y| >= |x - said(y)| - |y - said(y)|: nothing within the radius is passed over
            i, j = np.nonzero(np.sqrt(near) <= radius + np.array(y.column("off").to_pylist())[None, :] + 1e-7)
            cos = np.concatenate([(xv[i[k : k + 65536]] * yv[j[k : k + 65536]]).sum(1) for k in range(0, len(i), 65536)] or [np.zeros(0)])
            i, j = i[cos >= threshold], j[cos >= threshold]
            xi, yi, xo = (np.array(c.to_pylist(), np.int64) for c in (x.column("id"), y.column("id"), x.column("own")))
            probes = y.column("probes").to_pylist()
            back = np.full((y.num_rows, max(map(len, probes))), -1)
            for r, p in enumerate(probes):
                back[r, : len(p)] = p
            # a pair that both ends find counts where the smaller one asks
            twice = (back[j] == xo[i][:, None]).any(1)
            keep = (xi[i] != yi[j]) & (~twice | (xi[i] < yi[j]))
            a, b = xi[i][keep], yi[j][keep]
            xc, yc = (np.array(c.to_pylist(), np.int64) for c in (x.column("copies"), y.column("copies")))
            ends, into = np.unique(np.concatenate([a, b]), return_inverse=True)
            gained = np.bincount(into, np.concatenate([yc[j][keep], xc[i][keep]])).astype(np.int64)
            add = dict(zip(ends.tolist(), gained.tolist(), strict=True))
            root = np.arange(len(ends))
            p, q = into[: len(a)], into[len(a) :]
            while True:  # smallest label of the group
                low = root.copy()
                np.minimum.at(low, p, root[q])
                np.minimum.at(low, q, root[p])
                low = low[low]
                if (low == root).all():
                    break
                root = low
            found = dict(zip(ends.tolist(), ends[root].tolist(), strict=True))
        return pa.table({"id": pa.array(list(add), pa.int64()), "add": pa.array(list(add.values()), pa.int64()), "root": pa.array([found[k] for k in add], pa.int64())})

    rows = member.select(columns).union(query.select(columns))
    return rows.groupBy("label", "dim", "list", "mcell", "qcell").applyInArrow(compare, "id bigint, add bigint, root bigint")


def near_vectors(df: DataFrame, threshold: float = THRESHOLD, probes: int | None = PROBES, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """(id, n_links, component_id, kept) of every vector.

    Vectors link when their labels are equal and not null, their lengths are
    equal and their cosine in double precision is at least ``threshold``;
    those that are null, empty, zero or hold null or non-finite components
    link with nothing. Equal vectors are one class that counts its copies. An
    index of inverted lists and residual codes, fitted on a bounded sample,
    names candidates without loss inside a probed list; a link is missed only
    if neither end's probes (the nearest ``probes`` lists) hold the other, and
    with None, which seeks in every list that can hold a partner, none is.
    Every link is reranked exactly, and floats or doubles are never narrowed. A repeated id is a vector of its own in the counts; a
    null id links with nothing, has no component and is not kept.
    """
    scratch = Scratch(df.sparkSession, "vectors")
    kind = "array<float>" if df.schema[vector_col].dataType.simpleString() == "array<float>" else "array<double>"
    rows = slim(df, id=id_col, v=vector_col, label=label_col).select(F.col("id").cast("bigint").alias("id"), F.col("v").cast(kind).alias("v"), F.col("label").cast("string").alias("label"))
    number = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    good = F.col("id").isNotNull() & F.col("label").isNotNull() & F.coalesce(F.forall("v", number) & F.exists("v", lambda x: x != 0), F.lit(False))
    reps = scratch.table("reps", rows.filter(good).groupBy("label", "v").agg(F.min("id").alias("id"), F.count("*").alias("copies")).select("id", "copies", "label", "v"))
    found = scratch.table("found", linked(scratch, reps, threshold, probes))
    comp = components(scratch, found.filter("id <> root").select(F.col("id").alias("a"), F.col("root").alias("b")))
    gained = found.groupBy("id").agg(F.sum("add").alias("add"))
    done = scratch.table("done", reps.join(gained, "id", "left").join(comp, "id", "left").select("label", "v", (F.col("copies") - 1 + F.coalesce("add", F.lit(0))).alias("n_links"), F.coalesce("component", "id").alias("component_id")))
    scratch.drop("placed", "sizes", "found", "reps")
    out = rows.withColumn("own", F.when(good, F.col("label"))).join(done.withColumnRenamed("label", "own"), ["own", "v"], "left")
    comp_id = F.coalesce("component_id", "id")
    return out.select(F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"), comp_id.alias("component_id"), F.coalesce(F.col("id") == comp_id, F.lit(False)).alias("kept"))
