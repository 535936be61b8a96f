"""SentencePiece encoding and decoding by an Aho-Corasick automaton over the pieces and one pass of dynamic programming."""

from __future__ import annotations

import re
import zlib
from array import array
from heapq import heappop, heappush

from pyspark.sql import DataFrame

from stratawork.llm.support import prepare, slim
from stratawork.llm.tokens import Memo

#: Stretches of text, and pairs of pieces, that a worker keeps.
KEPT = 500_000
MARK = "▁"
_STRETCH = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")
UNIGRAM, BPE = 1, 2


def _varint(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        b = data[at]
        value |= (b & 127) << shift
        at, shift = at + 1, shift + 7
        if b < 128:
            return value, at


def fields(data: bytes):
    """(number, wire type, value, first byte, end) of the fields of a protocol message."""
    at = 0
    while at < len(data):
        first = at
        key, at = _varint(data, at)
        number, wire = key >> 3, key & 7
        if wire == 0:
            value, at = _varint(data, at)
        elif wire == 2:
            n, at = _varint(data, at)
            value, at = data[at : at + n], at + n
        else:
            n = 8 if wire == 1 else 4
            value, at = data[at : at + n], at + n
        yield number, wire, value, first, at


class PieceModel:
    """Encodes as the sentencepiece library does with this model file, ids in the library's numbering.

    The automaton names, at each place, every piece that ends there (its
    output links); one pass relaxes the places with them. In a unigram model
    the best sum of scores wins, which is Viterbi. A byte-pair model defines
    its result by merges, not by a sum, so there a piece is admitted at a
    place if merging leaves it beside the last piece of the prefix before it
    (``_admitted``); exactly one is, and what is found is the library's result.
    Pieces hold the space mark at their start only, so stretches between marks
    (and line breaks, if no piece holds any) are independent and each is worked
    out once and kept.
    """

    def __init__(self, data: bytes):
        import ahocorasick
        import sentencepiece

        self.sp = sp = sentencepiece.SentencePieceProcessor(model_proto=data)
        spec = {n: v for n, _, v, _, _ in fields(data) if n in (2, 3)}
        trainer, norm = ({n: v for n, _, v, _, _ in fields(spec.get(k, b""))} for k in (2, 3))
        self.kind = trainer.get(3, UNIGRAM)
        self.fallback = bool(trainer.get(35, 0))
        self.prefix, squeeze, escape = (bool(norm.get(k, 1)) for k in (3, 4, 5))
        self.size = sp.get_piece_size()
        self.unk = sp.unk_id()
        ids = range(self.size)
        self.byte = {int(sp.id_to_piece(i)[3:5], 16): i for i in ids if sp.is_byte(i)}
        self.back = {i: b for b, i in self.byte.items()}
        self.piece = [sp.id_to_piece(i) for i in ids]
        self.score = [sp.get_score(i) for i in ids]
        plain = [i for i in ids if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))]
        self.id = {self.piece[i]: i for i in plain}
        #: What the proof above needs of a model; otherwise the library itself encodes.
        self.direct = self.kind in (UNIGRAM, BPE) and not squeeze and escape and not norm.get(2) and all(MARK not in p.lstrip(MARK) for p in self.id) and not any(v for n, _, p, _, _ in fields(data) if n == 1 for m, _, v, _, _ in fields(p) if m == 3 and v == 4)
        self.auto = ahocorasick.Automaton()
        for p, i in self.id.items():
            self.auto.add_word(p, (i, len(p), self.score[i]))
        self.auto.make_automaton()
        #: What an id reads as, and the characters that are pieces: a text of these alone comes back and lacks nothing.
        self.reads = [" ⁇ " if i == self.unk else "" if sp.is_control(i) else self.piece[i].replace(MARK, " ") for i in ids]
        self.single = {p for p in self.id if len(p) == 1}
        # white space that no piece holds is spelled as bytes wherever it stands, so what is on both sides of it is independent too
        apart = "".join(c for c in "\n\r\t" if self.fallback and not any(c in p for p in self.id))
        self.stretch = re.compile(f"[{apart}]|{MARK}*[^{MARK}{apart}]+|{MARK}+") if apart else _STRETCH
        self.lost = min((self.score[i] for i in plain), default=0.0) - 10
        self.kept: dict[str, tuple[bytes, int, bool]] = Memo(self._kept, KEPT)
        self.pairs: dict[tuple[int, int], bool] = Memo(self._admitted, KEPT)

    # -- encoding ---------------------------------------------------------

    def encode(self, text: str | None) -> list[int]:
        """Ids of a whole text; null and empty are none."""
        return array("I", self.encoded(text)[0]).tolist()

    def encoded(self, text: str | None) -> tuple[bytes, bool]:
        """Ids as unsigned 32-bit integers, and whether decoding them gives the text back."""
        return self.measured(text)[:2]

    def measured(self, text: str | None) -> tuple[bytes, bool, int | None]:
        """``encoded``, and the tokens of the segmentation with the best sum of scores.

        A stretch starts with a mark or is ASCII by itself, and neither ends
        or starts a longer sequence of byte pieces, so a text comes back if its
        stretches do. A model or text outside what the pass was
        proven for goes to the library whole, and has no such number.
        """
        if not text:
            return b"", True, 0
        if not self.direct or "\0" in text:
            ids = self.sp.encode(text)
            return array("I", ids).tobytes(), self.decode(ids) == text.replace(MARK, " "), None
        found = list(map(self.kept.__getitem__, self.stretch.findall((MARK if self.prefix else "") + text.replace(" ", MARK))))
        return b"".join([f[0] for f in found]), all([f[2] for f in found]), sum([f[1] for f in found])

    def _kept(self, part: str) -> tuple[bytes, int, bool]:
        """(ids, tokens of the best sum, whether it comes back) of a stretch."""
        plain = self.single.issuperset(part)
        if self.kind != BPE or part.startswith(MARK * 2):  # runs of marks share one score: ties go by place
            best = self._spell(self._relaxed(part))
            ids = best if self.kind != BPE else self._spell(self._merged(part))
            count = len(best)
        elif plain:
            ids, count = self._passed(part)
        else:
            ids, count = self._spell(self._admissible(part)), len(self._spell(self._relaxed(part)))
        return array("I", ids).tobytes(), count, plain or self._text(ids) == part.replace(MARK, " ")

    def _passed(self, s: str) -> tuple[list[int], int]:
        """(ids, tokens of the best sum) of a stretch without lacking characters: both relaxations in one pass over the outputs."""
        n = len(s)
        ids, sizes = [-1] * (n + 1), [0] * (n + 1)
        best, count = [0.0] + [-1e300] * n, [0] * (n + 1)
        pairs = self.pairs
        for end, (i, size, score) in self.auto.iter(s):
            end += 1
            at = end - size
            if not sizes[end] and (not at or pairs[(ids[at], i)]):
                ids[end], sizes[end] = i, size
            total = best[at] + score
            if total > best[end]:
                best[end], count[end] = total, count[at] + 1
        out, at = [], n
        while at:
            out.append(ids[at])
            at -= sizes[at]
        return out[::-1], count[n]

    def _admissible(self, s: str) -> list[tuple[int, str]]:
        """The pieces that merging leaves: at each place, in order, the one that merging leaves beside the last piece of the prefix before it."""
        n = len(s)
        ids, sizes = [-1] * (n + 1), [0] * (n + 1)  # of the piece that ends at a place; size 0: a lacking character
        for end, (i, size, _) in self.auto.iter(s):
            end += 1
            if not sizes[end] and (end == size or self.pairs[(ids[end - size], i)]):
                ids[end], sizes[end] = i, size
        return self._back(s, ids, sizes)

    def _relaxed(self, s: str) -> list[tuple[int, str]]:
        """The pieces with the best sum of scores: one Viterbi pass over the automaton's outputs."""
        n = len(s)
        ids, sizes, best = [-1] * (n + 1), [0] * (n + 1), [0.0] + [-1e300] * n
        for end, found in self._matches(s):
            one = False
            for i, size, score in found:
                one |= size == 1
                total = best[end - size] + score
                if total > best[end]:
                    best[end], ids[end], sizes[end] = total, i, size
            if not one and best[end - 1] + self.lost > best[end]:
                best[end], ids[end], sizes[end] = best[end - 1] + self.lost, -1, 1
        return self._back(s, ids, sizes)

    @staticmethod
    def _back(s: str, ids: list[int], sizes: list[int]) -> list[tuple[int, str]]:
        out, at = [], len(s)
        while at:
            size = sizes[at] or 1
            out.append((ids[at], s[at - size : at]))
            at -= size
        return out[::-1]

    def _matches(self, s: str):
        """(end, pieces that end there) for every place, in order."""
        at, found = 1, []
        for end, hit in self.auto.iter(s):
            end += 1
            while at < end:
                yield at, found
                at, found = at + 1, []
            found.append(hit)
        while at <= len(s):
            yield at, found
            at, found = at + 1, []

    def _admitted(self, pair: tuple[int, int]) -> bool:
        """Whether merging leaves piece ``a`` and then piece ``b`` of their joined text; a lacking character (-1) joins nothing."""
        a, b = pair
        if a < 0:
            return len(self._merged(self.piece[b])) == 1
        if self.piece[a] + self.piece[b] in self.id:
            return False
        return [i for i, _ in self._merged(self.piece[a] + self.piece[b])] == [a, b]

    def _merged(self, s: str) -> list[tuple[int, str]]:
        """Best-scored merges first, the leftmost of equals, until none is a piece; n log n by a heap over linked parts."""
        parts, n = list(s), len(s)
        after, before, alive = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n
        heap: list[tuple[float, int, int, int]] = []

        def offer(k: int, j: int) -> None:
            if k >= 0 and j < n and (i := self.id.get(parts[k] + parts[j])) is not None:
                heappush(heap, (-self.score[i], k, len(parts[k]), len(parts[j])))

        for k in range(n - 1):
            offer(k, k + 1)
        while heap:
            _, k, left, right = heappop(heap)
            j = after[k]
            if not alive[k] or j >= n or len(parts[k]) != left or len(parts[j]) != right:
                continue  # one of the two has been merged since
            parts[k] += parts[j]
            alive[j], after[k] = False, after[j]
            if after[k] < n:
                before[after[k]] = k
            offer(before[k], k)
            offer(k, after[k])
        return [(self.id.get(p, -1), p) for p, ok in zip(parts, alive, strict=True) if ok]

    def _spell(self, parts: list[tuple[int, str]]) -> list[int]:
        """Ids, lacking characters as their bytes; without those, a run of them is one unknown."""
        out: list[int] = []
        for i, p in parts:
            if i >= 0:
                out.append(i)
            elif self.fallback:
                out += [self.byte[b] for b in p.encode()]
            elif not (out and out[-1] == self.unk):
                out.append(self.unk)
        return out

    # -- decoding ---------------------------------------------------------

    def decode(self, ids: list[int]) -> str:
        """The text of ids: runs of bytes as UTF-8, marks as spaces, the added first space gone."""
        text = self._text(ids)
        return text[1:] if self.prefix and text.startswith(" ") else text

    def _text(self, ids: list[int]) -> str:
        out: list[str] = []
        run = bytearray()
        for i in ids:
            b = self.back.get(i)
            if b is not None:
                run.append(b)
                continue
            if run:
                out.append(run.decode("utf-8", "replace"))
                run.clear()
            out.append(self.reads[i])
        if run:
            out.append(run.decode("utf-8", "replace"))
        return "".join(out)


_models: dict[str, PieceModel] = {}


def model(path: str) -> PieceModel:
    """One model a worker process and file."""
    if path not in _models:
        with open(path, "rb") as f:
            _models[path] = PieceModel(f.read())
    return _models[path]


def encode_pieces(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids) of every whole text, null and empty: no ids; a repeated id gives a row each time."""
    prepare(df.sparkSession)

    def run(batches):
        import pyarrow as pa

        m = model(path)
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([m.encode(t) for t in b.column(1).to_pylist()], pa.list_(pa.int32()))], names=["id", "ids"])

    kind = df.schema[id_col].dataType.simpleString()
    return slim(df, id=id_col, text=text_col).mapInArrow(run, f"id {kind}, ids array<int>").withColumnRenamed("id", id_col)


def decode_pieces(df: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(id, text) of lists of ids; null lists give null."""
    prepare(df.sparkSession)

    def run(batches):
        import pyarrow as pa

        m = model(path)
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([None if x is None else m.decode(x) for x in b.column(1).to_pylist()], pa.string())], names=["id", "text"])

    kind = df.schema[id_col].dataType.simpleString()
    return slim(df, id=id_col, ids=ids_col).mapInArrow(run, f"id {kind}, text string").withColumnRenamed("id", id_col)


def piece_digests(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_bytes, n_tokens, ids_crc32, round_trip, n_best_sum): each whole text encoded and decoded again.

    ids_crc32 is of the ids as little-endian unsigned 32-bit integers;
    round_trip says whether decoding gives the text back (the mark itself in a
    text comes back as a space, as in the library). n_best_sum is the number of
    tokens that the Viterbi pass over sums of scores gives, which for a unigram
    model is n_tokens and for a byte-pair model is at most that, or differs
    where merges take another way; null where the library encodes whole texts.
    """
    prepare(df.sparkSession)

    def run(batches):
        import pyarrow as pa

        m = model(path)
        for b in batches:
            rows = []
            for text in b.column(1).to_pylist():
                text = text or ""
                ids, back, best = m.measured(text)
                rows.append((len(text.encode()), len(ids) // 4, zlib.crc32(ids), back, best))
            cols = list(zip(*rows, strict=True)) or [()] * 5
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c, k) for c, k in zip(cols, kinds, strict=True))], names=["id", "n_bytes", "n_tokens", "ids_crc32", "round_trip", "n_best_sum"])

    kind = df.schema[id_col].dataType.simpleString()
    return slim(df, id=id_col, text=text_col).mapInArrow(run, f"id {kind}, n_bytes bigint, n_tokens bigint, ids_crc32 bigint, round_trip boolean, n_best_sum bigint").withColumnRenamed("id", id_col)
