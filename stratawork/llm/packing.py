"""Best-fit packing of token sequences, improved by swaps between underfull bins."""

from __future__ import annotations

import itertools
import zlib
from array import array
from bisect import bisect_left, insort
from collections import defaultdict

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratawork.llm.support import Scratch, prepare, slim
from stratawork.llm.tokens import encoder

#: Tokens of a sequence, and pieces that one task packs. A shard leaves at most about one poorly filled sequence.
CAPACITY, SHARD_PIECES = 2048, 20_000
#: Limits of two-for-one exchanges: emptiest bins that they are sought with, and pieces of a bin in one; None is no limit.
DONORS, WIDEST = None, None


def pieces(df: DataFrame, path: str, end_id: int = 0, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces of the tokenised documents: (id, piece, start, length, ids_crc32).

    A document is its ids and ``end_id``; only one longer than ``capacity`` is
    cut. Null and empty texts are the end id alone. A repeated id gives its
    pieces each time. One narrow pass.
    """
    prepare(df.sparkSession)
    end = array("I", [end_id]).tobytes()

    def run(batches):
        import pyarrow as pa

        enc = encoder(path)
        for b in batches:
            ids, rows = b.column(0), []
            for k, text in enumerate(b.column(1).to_pylist()):
                data = enc.ids(text) + end
                for p, at in enumerate(range(0, len(data), 4 * capacity)):
                    part = data[at : at + 4 * capacity]
                    rows.append((k, p, at // 4, len(part) // 4, zlib.crc32(part)))
            cols = list(zip(*rows, strict=True)) or [()] * 5
            yield pa.RecordBatch.from_arrays([ids.take(pa.array(cols[0], pa.int64())), pa.array(cols[1], pa.int32()), *(pa.array(c, pa.int64()) for c in cols[2:])], names=["id", "piece", "start", "length", "ids_crc32"])

    kind = df.schema[id_col].dataType.simpleString()
    return slim(df, id=id_col, text=text_col).mapInArrow(run, f"id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint")


class _Bin:
    __slots__ = ("fill", "items", "number")

    def __init__(self, number: int):
        self.number, self.fill, self.items = number, 0, []


def best_fit(lengths: list[int], capacity: int) -> list[list[int]]:
    """Best-fit decreasing: the places of ``lengths`` by bin."""
    bins: list[list[int]] = []
    by_room: dict[int, list[int]] = defaultdict(list)
    rooms: list[int] = []  # sorted distinct rooms that some bin has
    for k in sorted(range(len(lengths)), key=lambda k: (-lengths[k], k)):
        n = lengths[k]
        at = bisect_left(rooms, n)
        if at == len(rooms):
            b, room = len(bins), capacity
            bins.append([])
        else:
            room = rooms[at]
            b = by_room[room].pop()
            if not by_room[room]:
                rooms.pop(at)
        bins[b].append(k)
        if room - n:
            if not by_room[room - n]:
                insort(rooms, room - n)
            by_room[room - n].append(b)
    return bins


def swap_search(bins: list[list[int]], lengths: list[int], capacity: int, rounds: int | None = None, donors: int | None = DONORS, widest: int | None = WIDEST) -> list[list[int]]:
    """Moves, one-for-one and two-for-one exchanges between underfull bins until none helps.

    ``donors`` limits the two-for-one exchanges to so many of the emptiest
    bins, ``widest`` to bins of so many pieces, ``rounds`` the passes; None,
    the default, is no limit, and the search ends where no exchange of these
    kinds is left.

    Takes the fullest underfull bin as receiver and the emptier ones as donors:
    a change that puts d more tokens into the receiver and takes d from a
    donor not fuller than it raises the sum of squared fills by
    2d(receiver - donor + d) > 0, so the search ends; emptied bins go. Donors'
    pieces are found by length and their pairs by sum, so a round costs the
    pieces and pairs of the underfull bins, not pairs of bins.
    """
    full, work = [], []
    for items in bins:
        b = _Bin(len(work))
        b.items, b.fill = list(items), sum(lengths[k] for k in items)
        (full if b.fill == capacity else work).append(b)
    for _ in itertools.count() if rounds is None else range(rounds):
        work = sorted((b for b in work if b.items), key=lambda b: (-b.fill, b.number))
        rank = {b.number: r for r, b in enumerate(work)}
        least = max(0, len(work) - donors) if donors else 0
        ones, twos = _Index(), _Index()  # the pieces and the pairs of the donors; those behind a receiver are never fuller, as donors only lose

        def enter(b: _Bin, r: int, into: bool) -> None:
            for k in b.items:
                ones.change(lengths[k], (r, k), into)
            if r >= least and not (widest and len(b.items) > widest):
                for total, pair in _sums(b.items, lengths).items():
                    twos.change(total, (r, *pair), into)

        for r, b in enumerate(work):
            enter(b, r, True)
        gained = False
        for r, b in enumerate(work):
            enter(b, r, False)
            while b.items and b.fill < capacity and (change := _change(b, ones, twos, lengths, capacity, least, widest)):
                out, back, at = change
                donor = work[at]
                enter(donor, at, False)
                for k in out:
                    b.items.remove(k)
                    donor.items.append(k)
                for k in back:
                    donor.items.remove(k)
                    b.items.append(k)
                enter(donor, at, True)
                d = sum(lengths[k] for k in back) - sum(lengths[k] for k in out)
                b.fill, donor.fill, gained = b.fill + d, donor.fill - d, True
        if not gained:
            break
    return [b.items for b in full + work if b.items]


class _Index:
    """Entries (rank of bin, pieces) by number of tokens; bit n of ``known`` is whether n has any."""

    def __init__(self):
        self.at: dict[int, list[tuple[int, ...]]] = defaultdict(list)
        self.known = 0

    def change(self, n: int, entry: tuple[int, ...], into: bool) -> None:
        found = self.at[n]
        if into:
            insort(found, entry)
            self.known |= 1 << n
        else:
            del found[bisect_left(found, entry)]
            if not found:
                self.known ^= 1 << n


def _sums(items: list[int], lengths: list[int]) -> dict[int, tuple[int, int]]:
    """A pair of pieces for each sum that two of them have. Two of a length stand for all: a bin has few different lengths, about the root of twice its tokens at most."""
    by_length: dict[int, list[int]] = {}
    for k in items:
        if len(same := by_length.setdefault(lengths[k], [])) < 2:
            same.append(k)
    few = [k for same in by_length.values() for k in same]
    sums: dict[int, tuple[int, int]] = {}
    for x, y in itertools.combinations(few, 2):
        sums.setdefault(lengths[x] + lengths[y], (x, y))
    return sums


def _change(b: _Bin, ones: _Index, twos: _Index, lengths: list[int], capacity: int, least: int, widest: int | None) -> tuple[list[int], list[int], int] | None:
    """The change (out, in, rank of the donor) that fills b most: a move, one piece against one or two, or two against one; of equal ones the simplest, from the emptiest donor."""
    fits = (1 << (capacity - b.fill + 1)) - 2  # bits of the gains that there is room for
    own = sorted({lengths[k]: k for k in b.items}.items())
    best, gain = None, 0

    def seek(index: _Index, n: int, out: list[int], from_rank: int = 0) -> None:
        nonlocal best, gain
        hits = (index.known >> n) & fits
        while (d := hits.bit_length() - 1) > gain:
            at, *back = index.at[n + d][-1]
            if at >= from_rank:
                best, gain = (out, back, at), d
                return
            hits ^= 1 << d

    seek(ones, 0, [])
    for n, k in own:
        seek(ones, n, [k])
    for n, k in own:
        seek(twos, n, [k], least)
    if not (widest and len(b.items) > widest):
        for total, pair in _sums(b.items, lengths).items():
            seek(ones, total, list(pair), least)
    return best


def pack(df: DataFrame, capacity: int = CAPACITY, shard_pieces: int = SHARD_PIECES, seed: int = 7, donors: int | None = DONORS, widest: int | None = WIDEST) -> DataFrame:
    """Packs rows with a ``length`` (1 to capacity): all columns plus sequence_id and offset.

    Rows are dealt evenly over shards of about ``shard_pieces`` by a hash of
    their place in ``df``, not of what they hold, each packed by best-fit
    decreasing and ``swap_search`` in one task: memory follows the shard, and
    equal or repeated rows cannot make one hot. Ties are broken by id and
    piece; repeated rows are packed each on its own. An empty input gives no
    rows. ``donors`` and ``widest`` may limit the search for exchanges.
    """
    spark = df.sparkSession
    n = df.count()
    shards = max(1, -(-n // shard_pieces))
    kinds = df.schema

    def run(key, table):
        import pyarrow as pa

        table = table.drop_columns(["__shard"]).sort_by([(c, "ascending") for c in ("id", "piece", "start", "ids_crc32") if c in table.column_names])
        lengths = table.column("length").to_pylist()
        bins = swap_search(best_fit(lengths, capacity), lengths, capacity, donors=donors, widest=widest)
        seq, off = [0] * len(lengths), [0] * len(lengths)
        for number, items in enumerate(bins):
            at = 0
            for k in items:
                seq[k], off[k] = (key[0].as_py() << 32) + number, at
                at += lengths[k]
        return table.append_column("sequence_id", pa.array(seq, pa.int64())).append_column("offset", pa.array(off, pa.int64()))

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kinds) + ", sequence_id bigint, offset bigint"
    shard = F.pmod(F.xxhash64(F.lit(seed), F.monotonically_increasing_id()), F.lit(shards)).cast("int")
    prepare(spark)
    return df.withColumn("__shard", shard).groupBy("__shard").applyInArrow(run, schema)


def pack_documents(df: DataFrame, path: str, end_id: int = 0, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text", donors: int | None = DONORS, widest: int | None = WIDEST) -> DataFrame:
    """Tokenises, cuts and packs whole documents: (id, piece, start, length, ids_crc32, sequence_id, offset).

    Null and empty texts are one token (the end id). The small table of pieces
    is written to the shared folder, as counting and packing read it.
    """
    scratch = Scratch(df.sparkSession, "pack")
    table = scratch.table("pieces", pieces(df, path, end_id, capacity, id_col, text_col))
    return pack(table, capacity, donors=donors, widest=widest).withColumnRenamed("id", id_col)
