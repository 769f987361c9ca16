"""Merging of two sorted runs in independent pieces of equal work.

A diagonal i + j = d of the grid of two sorted arrays crosses the merge path in one place, found by
binary search. Cutting along evenly spaced diagonals gives pieces that are merged without regard to
each other, however unlike the arrays are.
"""

from __future__ import annotations

import numpy as np

PIECE = 1 << 16   # elements of both arrays merged in one piece


def cuts(a: np.ndarray, b: np.ndarray, diagonals: np.ndarray) -> np.ndarray:
    """How many elements of `a` lie before the merge path's crossing of each diagonal; of equal elements, `a`'s come first."""
    low, high = np.maximum(diagonals - len(b), 0), np.minimum(diagonals, len(a))
    while (open_ := low < high).any():
        middle = (low + high) // 2
        at = np.where(open_, middle, 0)
        # a[middle] comes before b[d - middle - 1]: the crossing is further on.
        further = open_ & (a[np.minimum(at, len(a) - 1)] <= b[np.clip(diagonals - at - 1, 0, len(b) - 1)])
        low = np.where(further, middle + 1, low)
        high = np.where(open_ & ~further, middle, high)
    return low


def common(a: np.ndarray, b: np.ndarray, piece: int = PIECE) -> tuple[np.ndarray, np.ndarray]:
    """Places in `a` and in `b` of the values that both hold; both are strictly rising."""
    if not len(a) or not len(b):
        none = np.zeros(0, dtype=np.int64)
        return none, none
    total = len(a) + len(b)
    diagonals = np.append(np.arange(0, total, piece), total)
    left = cuts(a, b, diagonals)
    right = diagonals - left
    found_a, found_b = [], []
    for k in range(len(diagonals) - 1):
        i, j = left[k], left[k + 1]
        own = b[right[k]:right[k + 1]]
        # The element before the piece belongs to its left neighbour; its equal may be the first here.
        begin = max(i - 1, 0)
        place = begin + np.searchsorted(a[begin:j], own)
        hit = np.flatnonzero((place < j) & (a[np.minimum(place, len(a) - 1)] == own))
        found_a.append(place[hit])
        found_b.append(right[k] + hit)
    return np.concatenate(found_a), np.concatenate(found_b)
