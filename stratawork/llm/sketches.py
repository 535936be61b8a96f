"""Parity sketches of shingle sets: the blocks whose equality the pigeonhole join tests."""

from __future__ import annotations

import math

import numpy as np

from stratawork.llm.shingles import mix

#: Blocks that a sketch puts into the join, for sets so large that it has more.
JOINED_BLOCKS = 128
#: Up to this size each shingle is a block of its own.
SINGLE = 64
#: Low bits of a block's key that hold its band.
BAND_BITS = 6
_PARITY = np.uint64(0xA0761D6478BD642F)


def sampled_least(joined: int, odds: float = 1e-10) -> int:
    """Equal blocks, of ``joined`` picked ones, that a pair of Jaccard similarity >= 0.75 has but for ``odds``.

    A block is equal and not empty if it holds a shingle of the intersection
    and none of the difference. Of P = 2**band blocks that is least likely for
    sizes P and 3P/4, with P/4 shingles apart and 3P/4 in common.
    """
    p = math.exp(-0.25) * (1 - math.exp(-0.75))
    total = 0.0
    for k in range(joined + 1):
        total += math.comb(joined, k) * p**k * (1 - p) ** (joined - k)
        if total >= odds:
            return k
    return joined


def bands(n: int) -> list[int]:
    """The size bands in which a set of n shingles can be the larger or the smaller of a pair with Jaccard similarity >= 0.75.

    Band k holds pairs whose larger set has 2**k to 2**(k+1) - 1 shingles; the
    smaller has at least 3/4 of the larger's. Sets under 3 link with equal sets only.
    """
    if n < 3:
        return []
    k = n.bit_length() - 1
    return [k, k + 1] if 4 * n >= 3 << (k + 1) else [k]


def blocks(s: np.ndarray, band: int, joined: int | None = JOINED_BLOCKS) -> np.ndarray:
    """Keys of the non-empty blocks of the sketch of ``s`` in a band, one 64-bit number each, whose low bits are the band.

    Every shingle is hashed to one of P blocks, and a block is the exclusive
    or of its shingles' hashes: it differs between two sets only if a shingle
    of their symmetric difference lies in it. So the number of differing
    blocks bounds the symmetric difference from below, and sets that differ
    in D < P shingles agree in a block. D is at most 2/7 of the larger size
    for Jaccard similarity >= 0.75, and P = 2**band is more. Of more than
    ``joined`` blocks so many are given, picked by place, which is a hash;
    None gives all.
    """
    if (2 << band) <= SINGLE:
        return _tagged(mix(s ^ np.uint64(band + 1)), band)
    per = (1 << band) // joined if joined else 1
    block = (s >> np.uint64(64 - band)).astype(np.int64)  # 2**band blocks
    order = np.flatnonzero(block % per == 0) if per > 1 else np.arange(len(s))
    if not len(order):
        return np.zeros(0, np.uint64)
    b = block[order]  # sorted, as s is
    first = np.flatnonzero(np.concatenate([[True], b[1:] != b[:-1]]))
    value = np.bitwise_xor.reduceat(mix(s[order]), first)
    return _tagged(mix(value ^ mix((b[first].astype(np.uint64) << np.uint64(8)) + np.uint64(band + 1))), band)


def _tagged(keys: np.ndarray, band: int) -> np.ndarray:
    return keys & ~np.uint64((1 << BAND_BITS) - 1) | np.uint64(band)


def parities(s: np.ndarray, band: int) -> np.ndarray:
    """The bit sketch of ``s`` in a band: 4 * 2**band bits (64 at least), each the parity of the shingles hashed to it.

    A shingle of the symmetric difference flips one bit, so the Hamming
    distance of two sketches is at most the size of that difference.
    """
    bits = max(64, 4 << band)
    odd = np.zeros(bits, np.uint8)
    np.bitwise_xor.at(odd, (mix(s ^ _PARITY) & np.uint64(bits - 1)).astype(np.int64), 1)
    return np.packbits(odd).view(np.int64)
