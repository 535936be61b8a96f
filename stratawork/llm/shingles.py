"""Word shingles of whole texts as 64-bit hashes, worked out for many texts at once."""

from __future__ import annotations

import hashlib

import numpy as np

WORDS = 5
_ONE = np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
#: Bytes that are hashed at once; a longer word extends it.
SEGMENT = 1 << 18


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_TABLE = mix(np.arange(1, 257, dtype=np.uint64) * _BASE)
_SPACE = np.isin(np.arange(256), [32, *range(9, 14)])
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_VALUE = np.where(_SPACE, np.uint64(0), _TABLE[_LOWER])
_PLACE = mix(np.arange(1, WORDS + 1, dtype=np.uint64)) | _ONE
_powers = np.ones(1, np.uint64)


def _power(n: int) -> np.ndarray:
    global _powers
    if len(_powers) < n:
        _powers = np.cumprod(np.concatenate([[_ONE], np.full(max(n, SEGMENT + 1) - 1, _BASE)]), dtype=np.uint64)
    return _powers[:n]


def word_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash, place of the first byte) of each word of UTF-8 bytes; words are what is between white space, A-Z lower-cased."""
    space = _SPACE[data]
    edge = np.flatnonzero(np.diff(np.concatenate([[True], space, [True]]).astype(np.int8)))
    start, end = edge[::2], edge[1::2]
    if not len(start):
        return np.zeros(0, np.uint64), start
    # the sum of value * base^place up to each byte; the bytes of a word weigh base^-start of that, so words end the powers anew
    total = np.concatenate([[np.uint64(0)], np.cumsum(_VALUE[data] * _power(len(data)), dtype=np.uint64)])
    return mix((total[end] - total[start]) * _inverse_power(start) + (end - start).astype(np.uint64)), start


_inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
_inverses = np.ones(1, np.uint64)


def _inverse_power(places: np.ndarray) -> np.ndarray:
    global _inverses
    n = int(places[-1]) + 1
    if len(_inverses) < n:
        _inverses = np.cumprod(np.concatenate([[_ONE], np.full(max(n, SEGMENT + 1) - 1, _inverse)]), dtype=np.uint64)
    return _inverses[places]


def words_by_text(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(word hashes of all texts, first word of each text and the end): ``data`` holds the texts, ``offsets`` where each starts and the last ends."""
    n = len(offsets) - 1
    hashes, counts = [], np.zeros(n, np.int64)
    i = 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + SEGMENT, "right")) - 1)
        a, b = int(offsets[i]), int(offsets[j])
        if b - a <= SEGMENT or j > i + 1:
            h, at = _guarded(data, a, b, offsets[i : j + 1])
            hashes.append(h)
            counts[i:j] = np.diff(np.searchsorted(at, offsets[i : j + 1] - a))
        else:  # one huge text: stretches that end at white space
            at = a
            while at < b:
                to = min(b, at + SEGMENT)
                while to < b and not _SPACE[data[to]]:
                    to += 1
                h, _ = word_hashes(data[at:to])
                hashes.append(h)
                counts[i] += len(h)
                at = to
        i = j
    return np.concatenate(hashes) if hashes else np.zeros(0, np.uint64), np.concatenate([[0], np.cumsum(counts)])


def _guarded(data: np.ndarray, a: int, b: int, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of texts that lie end to end: a space is put before each, so that no word spans two; places stay those of ``data``."""
    k = np.arange(len(offsets) - 1)
    sizes = np.diff(offsets)
    wide = np.full(b - a + len(k), 32, np.uint8)
    wide[np.arange(b - a) + np.repeat(k, sizes) + 1] = data[a:b]
    h, at = word_hashes(wide)
    text = np.searchsorted(offsets[:-1] - a + k, at, "right") - 1
    return h, at - text - 1


def shingle_sets(data: np.ndarray, offsets: np.ndarray, words: int = WORDS):
    """The sorted distinct shingle hashes of each text; fewer words than a shingle are one together, none give none."""
    h, first = words_by_text(data, offsets)
    m = len(h)
    whole = np.zeros(max(0, m - words + 1), np.uint64)
    for k in range(words):
        whole += h[k : m - words + 1 + k] * _PLACE[k]
    whole = mix(whole + np.uint64(words))
    for i in range(len(offsets) - 1):
        a, b = int(first[i]), int(first[i + 1])
        if b - a >= words:
            yield np.unique(whole[a : b - words + 1])
        elif b > a:
            yield mix(np.array([np.sum(h[a:b] * _PLACE[: b - a], dtype=np.uint64) + np.uint64(b - a)], np.uint64))
        else:
            yield np.zeros(0, np.uint64)


def column_bytes(column) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of an Arrow string column; null is empty."""
    import pyarrow as pa

    c = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if c.type != pa.large_string():
        c = c.cast(pa.large_string())
    if c.null_count:
        c = c.fill_null("")
    _, off, data = c.buffers()
    offsets = np.frombuffer(off, np.int64)[c.offset : c.offset + len(c) + 1]
    return (np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)), offsets


def set_key(s: np.ndarray) -> tuple[int, int]:
    """A 128-bit digest of a set."""
    d = hashlib.blake2b(s.tobytes(), digest_size=16).digest()
    return int.from_bytes(d[:8], "little", signed=True), int.from_bytes(d[8:], "little", signed=True)
