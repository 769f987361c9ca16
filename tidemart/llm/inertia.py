"""Leading eigenpairs of a symmetric matrix by spectrum slicing.

The signs of D in L D Lᵀ = A - shift count the eigenvalues below the shift (Sylvester's law of
inertia). Bisection on these counts isolates each leading eigenvalue, Rayleigh quotient iteration
inside the interval converges cubically with the same factors, and two further counts around the
result certify its number. Equal eigenvalues can't be isolated: their interval shrinks to rounding
width and each further vector is kept at right angles to those found.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import numpy as np

ALPHA = (1 + 17 ** 0.5) / 8   # balance of pivots of one and of two rows (Bunch and Kaufman)
STEPS = 60                    # iterations for one vector; cubic convergence takes three to six


class Factors:
    """L, D and the order of rows of a symmetric matrix, by diagonal pivots of one or two rows."""

    def __init__(self, matrix: np.ndarray):
        a = np.array(matrix, dtype=float)
        n = len(a)
        self.low, self.order, self.blocks = np.eye(n), np.arange(n), []
        self.tiny = np.finfo(float).eps * max(float(np.abs(a).max(initial=0.0)), np.finfo(float).tiny)
        k = 0
        while k < n:
            size = self._pivot(a, k)
            d = a[k:k + size, k:k + size].copy()
            if size == 1 and d[0, 0] == 0:
                d[0, 0] = self.tiny       # an exact eigenvalue: any sign will do, the vector is what counts
            rest = a[k + size:, k:k + size].copy()
            lower = np.linalg.solve(d, rest.T).T if size == 2 else rest / d[0, 0]
            a[k + size:, k + size:] -= lower @ rest.T
            self.low[k + size:, k:k + size] = lower
            self.blocks.append((k, d))
            k += size

    def _pivot(self, a: np.ndarray, k: int) -> int:
        """Brings the next pivot to the front of what is left; 1 or 2 rows."""
        if k == len(a) - 1:
            return 1
        column = np.abs(a[k + 1:, k])
        r = k + 1 + int(column.argmax())
        most, own = column[r - k - 1], abs(a[k, k])
        if own >= ALPHA * most:
            return 1
        others = np.abs(a[r, k:])
        others[r - k] = 0
        far = others.max()
        if own * far >= ALPHA * most * most:
            return 1
        if abs(a[r, r]) >= ALPHA * far:
            self._swap(a, k, r)
            return 1
        self._swap(a, k + 1, r)
        return 2

    def _swap(self, a: np.ndarray, i: int, j: int) -> None:
        if i != j:
            a[[i, j]] = a[[j, i]]
            a[:, [i, j]] = a[:, [j, i]]
            self.order[[i, j]] = self.order[[j, i]]
            known = min(i, j)
            self.low[[i, j], :known] = self.low[[j, i], :known]

    def negative(self) -> int:
        """How many eigenvalues are below zero; a pivot of two rows always has one of each sign."""
        return sum(1 if len(d) == 2 or d[0, 0] < 0 else 0 for _, d in self.blocks)

    def solve(self, right: np.ndarray) -> np.ndarray:
        x = right[self.order].astype(float)
        for k in range(len(x)):
            x[k + 1:] -= self.low[k + 1:, k] * x[k]
        for k, d in self.blocks:
            x[k:k + len(d)] = np.linalg.solve(d, x[k:k + len(d)]) if len(d) == 2 else x[k:k + 1] / d[0, 0]
        for k in range(len(x) - 1, -1, -1):
            x[k] -= self.low[k + 1:, k] @ x[k + 1:]
        out = np.empty_like(x)
        out[self.order] = x
        return out


class Slices:
    """Numbers of eigenvalues below the shifts tried so far."""

    def __init__(self, matrix: np.ndarray):
        self.matrix, n = matrix, len(matrix)
        radius = np.abs(matrix).sum(axis=1)
        self.scale = float(radius.max(initial=0.0))
        self.width = 8 * n * np.finfo(float).eps * self.scale
        self.shifts = [-self.scale - self.width, self.scale + self.width]
        self.counts = {self.shifts[0]: 0, self.shifts[1]: n}

    def below(self, shift: float) -> int:
        if shift not in self.counts:
            self.counts[shift] = Factors(self.matrix - shift * np.eye(len(self.matrix))).negative()
            insort(self.shifts, shift)
        return self.counts[shift]

    def interval(self, number: int) -> tuple[float, float]:
        """The narrowest known interval that holds the eigenvalue with that many below it."""
        at = bisect_left(self.shifts, True, key=lambda s: self.counts[s] > number)
        return self.shifts[at - 1], self.shifts[at]

    def isolate(self, number: int) -> tuple[float, float]:
        """An interval with that eigenvalue alone, or of rounding width."""
        while True:
            low, high = self.interval(number)
            if self.counts[high] - self.counts[low] == 1 or high - low <= self.width:
                return low, high
            self.below((low + high) / 2)


def leading(matrix: np.ndarray, count: int, least: float = 1e-12) -> tuple[np.ndarray, np.ndarray]:
    """The `count` largest eigenvalues, falling, and their unit vectors as columns; fewer where the
    matrix has no more above `least` of its scale. A vector's largest entry is positive."""
    n = len(matrix)
    slices = Slices(matrix)
    values, vectors = [], np.zeros((n, 0))
    for k in range(1, min(count, n) + 1):
        low, high = slices.isolate(n - k)
        if high <= least * slices.scale:
            break
        value, vector = _refined(slices, n - k, vectors, low, high)
        if value <= least * slices.scale:
            break
        top = int(np.abs(vector).argmax())
        values.append(value)
        vectors = np.column_stack([vectors, vector if vector[top] > 0 else -vector])
    return np.array(values), vectors


def _refined(slices: Slices, number: int, found: np.ndarray, low: float, high: float) -> tuple[float, np.ndarray]:
    matrix = slices.matrix
    eye = np.eye(len(matrix))

    def unit(x):
        for _ in range(2):
            x = x - found @ (found.T @ x)
        return x / np.linalg.norm(x)

    x = unit(np.random.default_rng(number).standard_normal(len(matrix)))
    shift, best = (low + high) / 2, (np.inf, 0.0, x)
    for step in range(STEPS):
        x = unit(Factors(matrix - shift * eye).solve(x))
        value = float(x @ matrix @ x)
        miss = float(np.linalg.norm(matrix @ x - value * x))
        inside = low - slices.width <= value <= high + slices.width
        if inside and miss < best[0]:
            best = miss, value, x
        elif inside and best[0] <= slices.width:
            break
        if inside and step:
            shift = value
        elif high - low > slices.width:   # not near enough for the quotient: halve the interval first
            slices.below((low + high) / 2)
            low, high = slices.isolate(number)
            shift = (low + high) / 2
    miss, value, x = best
    margin = max(slices.width, 2 * miss)
    if not slices.below(value - margin) <= number < slices.below(value + margin):
        raise ArithmeticError(f"counts don't confirm eigenvalue {len(matrix) - number}: {value}")
    return value, x
