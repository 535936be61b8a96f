"""Token counts and ids of whole texts, with resynchronised chunks for huge documents."""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame

from stratawork.llm.support import prepare, slim

#: Characters of a chunk, and of the first overlap of two chunks, of a huge document.
CHUNK_CHARS, OVERLAP_CHARS = 1 << 15, 1 << 8
#: Words, and parts of words, whose ids a worker keeps, and characters of one at most: together they bound its memory.
KEPT_WORDS, KEPT_PIECES, KEPT_CHARS = 350_000, 150_000, 48

_WORD_SPLIT = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
#: The same split for characters below U+0250, where Python's classes differ only in these numerals.
_WORDS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_²³¹¼½¾]+|[0-9²³¹¼½¾]|(?:[^\s\w]|_)+")
#: Characters whose folding or white space the two libraries might see differently.
_ODD = re.compile("[^\x09-\x0d\x20-\x7e\xa1-\xac\xae-įı-ɏ]")


def _byte_table() -> dict[int, int]:
    """The printable stand-in of each byte, by the rule of byte-level vocabularies."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = [b for b in range(256) if b not in plain]
    return {b: 256 + k for k, b in enumerate(rest)}


class Memo(dict):
    """A bounded dictionary that works out what it lacks.

    When full it keeps what came first, which holds most of the frequent keys,
    and starts anew after four times the bound of misses, as other texts came.
    Keys longer than ``longest`` are never kept.
    """

    def __init__(self, find: Callable, bound: int, longest: int = KEPT_CHARS):
        super().__init__()
        self.find, self.bound, self.longest, self.missed = find, bound, longest, 0

    def __missing__(self, key):
        value = self.find(key)
        if len(key) > self.longest:
            return value
        if len(self) < self.bound:
            self[key] = value
        else:
            self.missed += 1
            if self.missed > 4 * self.bound:
                self.clear()
                self.missed = 0
        return value


class Encoder:
    """Ids of a text exactly as the tokenizers library gives them without added special tokens.

    White space always ends a word here and no rule looks across it, so each
    word's ids are found once and kept. Texts or tokenizers outside what that
    was proven for go to the library itself. Special strings in a text become
    their own ids, which is the library's default.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        spec = json.loads(self.tok.to_str())
        norm, pre, model = spec.get("normalizer") or {}, spec.get("pre_tokenizer") or {}, spec["model"]
        steps = [(n["type"], (n.get("pattern") or {}).get("Regex"), n.get("content")) for n in norm.get("normalizers", [])]
        cuts = [(p["type"], (p.get("pattern") or {}).get("Regex"), p.get("invert"), p.get("add_prefix_space")) for p in pre.get("pretokenizers", [])]
        self.by_word = (
            steps == [("NFC", None, None), ("Replace", "\\s+", " "), ("Lowercase", None, None)]
            and cuts == [("Split", _WORD_SPLIT, True, None), ("ByteLevel", None, None, False)]
            and model["type"] == "BPE"
            and not model.get("dropout")
            and spec.get("truncation") is None
            and spec.get("padding") is None
            and all(not a["normalized"] and not a["lstrip"] and not a["rstrip"] and not a["single_word"] for a in spec["added_tokens"])
        )
        self.special = {a["content"]: a["id"] for a in spec["added_tokens"]}
        self.special_re = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.table = _byte_table()
        self.pieces = Memo(self._piece, KEPT_PIECES)
        self.words = Memo(self._word, KEPT_WORDS)

    def _piece(self, piece: str) -> bytes:
        text = piece if piece.isascii() else piece.encode().decode("latin-1").translate(self.table)
        return array("I", [t.id for t in self.tok.model.tokenize(text)]).tobytes()

    def _word(self, word: str) -> bytes:
        found = _WORDS.findall(word)
        return self.pieces[found[0]] if len(found) == 1 else b"".join(map(self.pieces.__getitem__, found))

    def _plain(self, text: str) -> bytes:
        if self.by_word and not _ODD.search(text):
            return b"".join(map(self.words.__getitem__, text.lower().split()))
        return array("I", self.tok.encode(text, add_special_tokens=False).ids).tobytes()

    def ids(self, text: str | None) -> bytes:
        """All ids as little-endian unsigned 32-bit integers; null is empty."""
        if not text:
            return b""
        if self.by_word and self.special_re and "<|" in text and self.special_re.search(text):
            return b"".join(array("I", [self.special[p]]).tobytes() if p in self.special else self._plain(p) for p in self.special_re.split(text) if p)
        return self._plain(text)

    def marked(self, text: str, at: int, end: int) -> list[tuple[int, int, int]]:
        """(start, end, id) of the tokens of text[at:end], in places of the whole text."""
        enc = self.tok.encode(text[at:end], add_special_tokens=False)
        return [(at + a, at + b, i) for (a, b), i in zip(enc.offsets, enc.ids, strict=True)]


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder a worker process and file."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def _stable(text: str, at: int) -> bool:
    """Whether a token that starts at ``at`` starts so in every chunk that holds the character before it.

    White space ends every rule of the split, is dropped itself, and no rule
    looks behind it: what follows is encoded alike whatever came before. A
    combining character could still join the space, so the place must hold a
    character that starts a letter, number or sign of its own.
    """
    import unicodedata

    return at > 0 and text[at - 1].isspace() and text[at - 1] not in "\x1c\x1d\x1e\x1f" and not unicodedata.combining(text[at])


def _common(text: str, have: list, more: list, start: int, end: int) -> int | None:
    """The first boundary that both chunks share in the overlap, is stable, and has the same tokens behind it."""
    last = max((k for k in range(start, end) if text[k].isspace()), default=start)  # what follows may be cut by the first chunk's end
    ours = {t for t in have if start <= t[0] < last}
    theirs = [t for t in more if start < t[0] < last]
    cut = None
    for a, b, i in reversed(theirs):
        if (a, b, i) not in ours:
            break
        if _stable(text, a):
            cut = a
    return cut


def spliced(enc: Encoder, text: str, chunk: int = CHUNK_CHARS, overlap: int = OVERLAP_CHARS, widened: Callable[[int], None] | None = None) -> Iterator[bytes]:
    """The ids of one huge text, a stretch at a time, from overlapping chunks encoded with offsets.

    Two chunks are spliced at their first common token boundary in the overlap
    that is proven stable (``_stable``) and behind which both have the same
    tokens up to the last white space of the first. Where there is none the
    overlap doubles; where it would reach back over the whole chunk, the chunk
    does. Two chunks are held at a time. ``widened`` gets each width that failed.
    """
    n, size, pos, end = len(text), chunk, 0, min(len(text), chunk)
    have = enc.marked(text, 0, end)
    while end < n:
        width, cut = overlap, None
        while cut is None and end - width > pos:
            start = end - width
            stop = min(n, start + max(chunk, 2 * width))
            more = enc.marked(text, start, stop)
            cut = _common(text, have, more, start, end)
            if cut is None:
                if widened:
                    widened(width)
                width *= 2
        if cut is None:
            size *= 2
            end = min(n, pos + size)
            have = enc.marked(text, pos, end)
            continue
        yield array("I", [i for a, _, i in have if a < cut]).tobytes()
        have, pos, end, size = [t for t in more if t[0] >= cut], cut, stop, chunk
    yield array("I", [i for _, _, i in have]).tobytes()


def count_tokens(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 2048, chunk: int = CHUNK_CHARS, overlap: int = OVERLAP_CHARS) -> DataFrame:
    """Bytes and tokens of every whole text: (id, n_bytes, n_tokens, over_limit, n_chunks, n_widened).

    Texts over ``chunk`` characters are encoded in overlapping chunks that are
    spliced again (``spliced``), so that memory follows the chunk, not the
    document; shorter ones at once. Null and empty texts have 0 bytes, 0
    tokens and 0 chunks. A repeated id gives a row each time. No shuffle: one
    pass over the scan. Columns other than the two named are not read.
    """
    prepare(df.sparkSession)

    def run(batches):
        import pyarrow as pa

        enc = encoder(path)
        for b in batches:
            rows = []
            for text in b.column(1).to_pylist():
                text, failed = text or "", []
                if len(text) > chunk:
                    parts = [len(p) // 4 for p in spliced(enc, text, chunk, overlap, failed.append)]
                else:
                    parts = [len(enc.ids(text)) // 4] if text else []
                n = sum(parts)
                rows.append((len(text.encode()), n, n > limit, len(parts), len(failed)))
            cols = list(zip(*rows, strict=True)) or [()] * 5
            kinds = (pa.int64(), pa.int64(), pa.bool_(), pa.int32(), pa.int32())
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c, k) for c, k in zip(cols, kinds, strict=True))], names=["id", "n_bytes", "n_tokens", "over_limit", "n_chunks", "n_widened"])

    kind = df.schema[id_col].dataType.simpleString()
    out = slim(df, id=id_col, text=text_col).mapInArrow(run, f"id {kind}, n_bytes bigint, n_tokens bigint, over_limit boolean, n_chunks int, n_widened int")
    return out.withColumnRenamed("id", id_col)
