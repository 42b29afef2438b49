"""The E8 lattice: nearest points, and the cells next to them."""

from __future__ import annotations

from itertools import combinations, product

import numpy as np

DIMENSIONS = 8


def shortest_vectors() -> np.ndarray:
    """The 240 shortest vectors: two entries of 1 or -1, or eight of 1/2 or -1/2 with an even number of minus signs."""
    out = []
    for i, j in combinations(range(8), 2):
        for s, t in product((1, -1), repeat=2):
            v = np.zeros(8)
            v[i], v[j] = s, t
            out.append(v)
    out += [np.array(s) / 2 for s in product((1, -1), repeat=8) if sum(x < 0 for x in s) % 2 == 0]
    return np.array(out)


def _nearest_even(x: np.ndarray) -> np.ndarray:
    """Nearest whole-number points with an even sum: round, and where the sum is odd, round the worst entry the other way."""
    r = np.rint(x)
    off = x - r
    odd = np.flatnonzero(r.sum(1) % 2 != 0)
    worst = np.abs(off[odd]).argmax(1)
    r[odd, worst] += np.where(off[odd, worst] >= 0, 1, -1)
    return r


def nearest(x: np.ndarray) -> np.ndarray:
    """Nearest lattice point of each row: the better of the even whole-number points and those shifted by 1/2."""
    a = _nearest_even(x)
    b = _nearest_even(x - 0.5) + 0.5
    return np.where((((x - a) ** 2).sum(1) <= ((x - b) ** 2).sum(1))[:, None], a, b)
