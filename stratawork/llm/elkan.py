"""Centroid clustering of integer vectors with Elkan's bounds.

A vector keeps an upper bound of the distance to its centroid and a lower one
for each centroid. Bounds follow the centroids' moves and are rounded away
from the truth, and a distance is skipped only if a bound says strictly that
it cannot matter, so ties are all looked at and the clusters are those of
comparing everything with everything. Distances that decide are exact integers.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratawork.llm.support import Scratch, slim

CENTROIDS, ROUNDS, DIM, SCALE, SEED = 40, 5, 64, 256, 2
#: Components from here on are left out: 64 squares of their differences would not fit into a long.
LARGEST = 1 << 27
_UP, _DOWN = np.inf, -np.inf


def _squares(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact squared distances of rows to one centroid, or row by row."""
    d = x - c
    return np.einsum("ij,ij->i", d, d)


def _root(squares: np.ndarray, way: float) -> np.ndarray:
    """Square roots rounded up or down, never the wrong way."""
    r = np.sqrt(squares.astype(np.float64))
    return np.maximum(np.nextafter(np.nextafter(r, way), way), 0)


def _float32(x: np.ndarray, way: float) -> np.ndarray:
    y = x.astype(np.float32)
    wrong = y < x if way > 0 else y > x
    y[wrong] = np.nextafter(y[wrong], np.float32(way))
    return y


class Centres:
    """Centroids of one round, how far each has moved since the last, and half of what lies between any two, rounded down."""

    def __init__(self, now: np.ndarray, before: np.ndarray | None = None):
        self.now = now
        self.moved = np.zeros(len(now)) if before is None else _root(_squares(now, before), _UP)
        between = np.stack([_root(_squares(now, c), _DOWN) for c in now])
        self.half = between / 2
        np.fill_diagonal(self.half, np.inf)
        self.least = self.half.min(axis=1)


def assign(x: np.ndarray, at: np.ndarray | None, upper: np.ndarray, lower: np.ndarray, centres: Centres) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """The nearest centroid of each vector (of equals the smaller number), its bounds, and how many distances that took.

    ``at`` is the centroid of the round before, None in the first round, and
    the bounds are those that it left; float32 holds them, rounded outwards.
    """
    n, k, done = len(x), len(centres.now), 0
    if at is None:
        at = np.zeros(n, np.int64)
        upper, lower = np.full(n, np.inf), np.zeros((n, k))
    else:
        upper = np.nextafter(upper.astype(np.float64) + centres.moved[at], _UP)
        lower = np.maximum(np.nextafter(lower.astype(np.float64) - centres.moved[None, :], _DOWN), 0)
    at = at.copy()
    open_ = np.flatnonzero(upper >= centres.least[at])  # the others are strictly nearer to theirs than to any
    exact = np.full(n, -1, np.int64)
    for c in range(k):
        rows = open_[(at[open_] != c)]
        rows = rows[(upper[rows] >= lower[rows, c]) & (upper[rows] >= centres.half[at[rows], c])]
        loose = rows[exact[rows] < 0]
        if len(loose):  # the bound may do once it is tight
            exact[loose] = _squares(x[loose], centres.now[at[loose]])
            upper[loose] = _root(exact[loose], _UP)
            lower[loose, at[loose]] = _root(exact[loose], _DOWN)
            done += len(loose)
            rows = rows[(upper[rows] >= lower[rows, c]) & (upper[rows] >= centres.half[at[rows], c])]
        if not len(rows):
            continue
        d = _squares(x[rows], centres.now[c])
        done += len(rows)
        lower[rows, c] = _root(d, _DOWN)
        nearer = (d < exact[rows]) | ((d == exact[rows]) & (c < at[rows]))
        rows, d = rows[nearer], d[nearer]
        at[rows], exact[rows], upper[rows] = c, d, _root(d, _UP)
    return at, _float32(upper, _UP), _float32(lower, _DOWN), done


def _matrix(column, width: int) -> np.ndarray:
    import pyarrow as pa

    c = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.asarray(c.flatten()).reshape(-1, width)


def _round(state: DataFrame, centres: Centres, first: bool) -> DataFrame:
    """``state`` (id, q and what the round before left) after one assignment."""
    k = len(centres.now)

    def run(batches):
        import pyarrow as pa

        for b in batches:
            if not b.num_rows:
                continue
            x = _matrix(b.column("q"), DIM).astype(np.int64)
            at, upper, lower = (None, None, None) if first else (np.asarray(b.column("at")).astype(np.int64), np.asarray(b.column("upper")), _matrix(b.column("lower"), k))
            at, upper, lower, done = assign(x, at, upper, lower, centres)
            flat = pa.ListArray.from_arrays(pa.array(np.arange(0, k * len(x) + 1, k, dtype=np.int32)), pa.array(lower.ravel()))
            spent = np.zeros(len(x), np.int64)
            spent[0] = done
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("q"), pa.array(at.astype(np.int32)), pa.array(upper), flat, pa.array(spent)], names=["id", "q", "at", "upper", "lower", "spent"])

    columns = ["id", "q"] if first else ["id", "q", "at", "upper", "lower"]
    return state.select(columns).mapInArrow(run, "id bigint, q array<int>, at int, upper float, lower array<float>, spent bigint")


def _moved(state: DataFrame, before: np.ndarray) -> np.ndarray:
    """Componentwise floors of the clusters' means; an empty cluster keeps its centroid. One row a cluster comes to the driver."""
    sums = state.groupBy("at").agg(F.count("*").alias("n"), *(F.sum(F.col("q")[i].cast("bigint")).alias(f"s{i}") for i in range(DIM))).collect()
    now = before.copy()
    for r in sums:
        now[r["at"]] = [r[f"s{i}"] // r["n"] for i in range(DIM)]
    return now


def kept(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(id, q) of the vectors of exactly DIM finite components, as floors of SCALE times each."""
    rows = slim(df, id=id_col, v=vector_col).select(F.col("id").cast("bigint").alias("id"), F.col("v").cast("array<double>").alias("v"))
    fits = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < LARGEST / SCALE)
    rows = rows.filter((F.size("v") == DIM) & F.forall("v", fits))
    return rows.select("id", F.transform("v", lambda x: F.floor(x * SCALE).cast("int")).alias("q"))


def starts(rows: DataFrame, k: int, seed: int) -> np.ndarray:
    """The vectors of the ``k`` smallest SHA-256 digests of ``seed:id``, in that order; a null id is none, equal ids go by components."""
    hashed = rows.filter("id is not null").select(F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")).cast("binary"), 256).alias("h"), "q")
    return np.array([r["q"] for r in hashed.orderBy("h", "q").limit(k).collect()], np.int64).reshape(-1, DIM)


def cluster(df: DataFrame, k: int = CENTROIDS, rounds: int = ROUNDS, seed: int = SEED, id_col: str = "vec_id", vector_col: str = "embedding", costs: list | None = None) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of every kept vector, see ``kept``.

    ``rounds`` times all vectors are assigned and centroids replaced, then all
    are assigned once more. Vectors that are null, of another length, with a
    null or non-finite component or one of 2**19 or more are left out. A
    repeated id is a vector of its own; a null id is assigned but starts no
    centroid. Fewer vectors with an id than ``k`` start fewer centroids, none
    gives no rows. ``costs`` takes the distances that each round took, at the
    price of one number a round.

    A round reads what the last one wrote, a vector with its bounds, and
    writes its own; centroids, of which there are ``k``, go with the code.
    Nothing is shuffled but one row of sums a task and cluster.
    """
    spark = df.sparkSession
    scratch = Scratch(spark, "clusters")
    state = scratch.table("kept", kept(df, id_col, vector_col))
    first = starts(state, k, seed)
    if not len(first):
        return state.limit(0).select(F.col("id").alias(id_col), F.lit(0).alias("cluster"), *(F.lit(0).cast("bigint").alias(c) for c in ("distance", "cluster_inertia", "inertia")), F.lit("").alias("centroid_sha256"))
    centres = Centres(first)
    for n in range(rounds + 1):
        state = scratch.table(f"round{n}", _round(state, centres, n == 0))
        scratch.drop(f"round{n - 1}" if n else "kept")
        if costs is not None:
            costs.append(state.agg(F.sum("spent")).first()[0] or 0)
        if n < rounds:
            centres = Centres(_moved(state, centres.now), centres.now)
    points = centres.now

    def measure(batches):
        import pyarrow as pa

        for b in batches:
            at = np.asarray(b.column("at"))
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("at"), pa.array(_squares(_matrix(b.column("q"), DIM).astype(np.int64), points[at]))], names=["id", "cluster", "distance"])

    far = scratch.table("distances", state.select("id", "q", "at").mapInArrow(measure, "id bigint, cluster int, distance bigint"))
    scratch.drop(f"round{rounds}")
    parts = far.groupBy("cluster").agg(F.sum("distance")).collect()
    names = {c: hashlib.sha256(",".join(map(str, points[c])).encode()).hexdigest() for c, _ in parts}
    table = spark.createDataFrame([(c, s, sum(x for _, x in parts), names[c]) for c, s in parts], "c int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    out = far.join(F.broadcast(table), F.col("cluster") == F.col("c"))  # one row a cluster
    return out.select(F.col("id").alias(id_col), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
