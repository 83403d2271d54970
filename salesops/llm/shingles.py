"""Words, shingles and MinHash symbols of UTF-8 texts, for use inside tasks."""

from __future__ import annotations

import numpy as np
import xxhash

SYMBOLS = 64  # hash functions of a signature, one 14-bit symbol each
PER_LONG = 4  # symbols in one 64-bit value
_CUT = 8192  # shingles hashed at a time
_MIX = np.uint64(0x9E3779B97F4A7C15)
_WEIGHTS = np.random.default_rng(20_24).integers(1, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_XORS = np.random.default_rng(7).integers(0, 2**63, SYMBOLS, dtype=np.uint64)[:, None]
_ODD = np.random.default_rng(11).integers(0, 2**63, SYMBOLS, dtype=np.uint64)[:, None] * np.uint64(2) + np.uint64(1)


def words_of(text: bytes | None) -> list[bytes]:
    """A-Z lower-cased, cut at ASCII blanks; null has no words."""
    return text.lower().split() if text else []


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _MIX
    return x ^ (x >> np.uint64(29))


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def run_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """A hash of each run of ``size`` neighbouring words, in order; none if there are fewer words."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for i in range(size):
        total = total * _MIX + hashes[i : i + n] * _WEIGHTS[i % 64]
    return mixed(total)


def shingle_set(text: bytes | None, size: int) -> np.ndarray:
    """The sorted hashes of the distinct shingles of ``size`` words; fewer words count as one shingle, no words as none."""
    hashes = word_hashes(words_of(text))
    if 0 < len(hashes) < size:
        return run_hashes(hashes, len(hashes)) ^ np.uint64(len(hashes))
    return np.unique(run_hashes(hashes, size))


def minhash_symbols(shingles: np.ndarray) -> np.ndarray:
    """SYMBOLS 14-bit symbols, packed by fours into int64 (16 bits apart); each is equal for two sets with their Jaccard similarity."""
    low = np.full(SYMBOLS, np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(shingles), _CUT):
        low = np.minimum(low, ((shingles[None, i : i + _CUT] ^ _XORS) * _ODD).min(axis=1))
    return np.ascontiguousarray((mixed(low) >> np.uint64(50)).astype(np.uint16)).view(np.int64)


def similar(one: np.ndarray, other: np.ndarray, percent: int) -> bool:
    """Whether two sorted shingle sets have a Jaccard similarity of ``percent`` / 100 or more."""
    if not len(one) or not len(other) or 100 * min(len(one), len(other)) < percent * max(len(one), len(other)):
        return False
    both = len(np.intersect1d(one, other, assume_unique=True))
    return 100 * both >= percent * (len(one) + len(other) - both)
