"""Word shingles of texts as 64-bit hashes, many texts at a time."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable

import numpy as np
import xxhash

WORDS = 5
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


class _Words(dict):
    """Hash of each word seen, emptied when it is full."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 1_000_000:
            self.clear()
        self[word] = out = xxhash.xxh64_intdigest(word)
        return out


_words = _Words()


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


def shingles(text: str | None, n: int = WORDS) -> np.ndarray:
    """Sorted distinct hashes of the text's n-word shingles; of its whole sequence of words where it has fewer; empty without words."""
    words = (text or "").encode().translate(_LOWER).split()  # bytes.split() parts at space and the characters 9 to 13
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(_words.__getitem__, words), np.uint64, len(words))
    if len(h) < n:
        h = np.append(h, np.uint64(len(h)))
        rolled = h[:1].copy()
        for x in h[1:]:
            rolled = _mixed(rolled * _MULTIPLIER + x)
        return rolled
    rolled = h[: len(h) - n + 1].copy()
    for i in range(1, n):
        rolled = _mixed(rolled * _MULTIPLIER + h[i : len(h) - n + 1 + i])
    return np.unique(rolled)


def digest(hashes: np.ndarray) -> bytes:
    """Of a set of shingles."""
    return hashlib.blake2b(hashes.tobytes(), digest_size=16).digest()


def signatures(sets: Iterable[np.ndarray], coordinates: int, seed: int = 1) -> np.ndarray:
    """Row for each non-empty set: for each coordinate the smallest value of its hash function over the set, 32 bits of it."""
    sets = list(sets)
    rng = np.random.default_rng(seed)
    a = rng.integers(0, 1 << 63, coordinates, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    b = rng.integers(0, 1 << 63, coordinates, dtype=np.uint64)
    out = np.empty((len(sets), coordinates), np.uint32)
    lo = 0
    while lo < len(sets):  # as many sets at a time as fit the cache
        hi, total = lo, 0
        while hi < len(sets) and (hi == lo or total + len(sets[hi]) <= 16_384):
            total += len(sets[hi])
            hi += 1
        h = np.concatenate(sets[lo:hi])
        starts = np.cumsum([0, *map(len, sets[lo : hi - 1])])
        for k in range(coordinates):
            x = (h ^ b[k]) * a[k]
            x ^= x >> np.uint64(32)
            x *= _MULTIPLIER
            out[lo:hi, k] = np.minimum.reduceat(x, starts) >> np.uint64(32)
        lo = hi
    return out
