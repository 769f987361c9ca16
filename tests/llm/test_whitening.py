import math
import random

import numpy as np
import pytest

from tidemart.llm import inertia, whitening

SCHEMA = "vec_id long, embedding array<float>, label int, component string, n int, row string"


def random_symmetric(n, seed, values=None):
    rng = np.random.default_rng(seed)
    q, _ = np.linalg.qr(rng.standard_normal((n, n)))
    values = rng.uniform(-5, 50, n) if values is None else np.array(values, dtype=float)
    m = q @ np.diag(values) @ q.T
    return (m + m.T) / 2


@pytest.mark.parametrize("seed", range(12))
def test_counts_equal_numbers_of_eigenvalues(seed):
    m = random_symmetric(3 + seed * 3, seed)
    true = np.linalg.eigvalsh(m)
    for shift in np.linspace(true[0] - 1, true[-1] + 1, 23):
        assert inertia.Factors(m - shift * np.eye(len(m))).negative() == (true < shift).sum()


@pytest.mark.parametrize("matrix", [np.zeros((4, 4)), np.array([[0.0, 1], [1, 0]]), np.eye(5) * 3, random_symmetric(20, 5),
                                    np.array([[0, 1, 2], [1, 0, 3], [2, 3, 0.0]])])
def test_solve_and_count_with_zero_diagonals(matrix):
    shifted = matrix - 0.37 * np.eye(len(matrix))
    right = np.arange(1.0, len(matrix) + 1)
    np.testing.assert_allclose(shifted @ inertia.Factors(shifted).solve(right), right, atol=1e-9)
    assert inertia.Factors(shifted).negative() == (np.linalg.eigvalsh(matrix) < 0.37).sum()


@pytest.mark.parametrize("values", [[9, 7, 5, 3, 1, 0.5], [9, 9, 9, 2, 1, 1], [5, 5 - 1e-9, 5 - 2e-9, 1, 0, 0], [4, 0, 0, 0, 0, 0], [2] * 6])
def test_leading_pairs(values):
    m = random_symmetric(6, 3, values)
    got, vectors = inertia.leading(m, 4)
    want = [v for v in sorted(values, reverse=True) if v > 1e-9][:4]
    np.testing.assert_allclose(got, want, rtol=1e-12, atol=1e-12)
    np.testing.assert_allclose(vectors.T @ vectors, np.eye(len(got)), atol=1e-12)
    np.testing.assert_allclose(m @ vectors, vectors * got, atol=1e-11)


def test_leading_equals_the_full_decomposition():
    m = random_symmetric(80, 9)
    got, vectors = inertia.leading(m, 16)
    values, whole = np.linalg.eigh(m)
    np.testing.assert_allclose(got, values[::-1][:16], rtol=1e-13)
    np.testing.assert_allclose(np.abs((whole[:, ::-1][:, :16] * vectors).sum(axis=0)), 1, atol=1e-11)


def brute_force(rows, components):
    """The contract, one vector at a time in whole numbers, with the library's full decomposition."""
    kept = [(i, tuple(math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v)) for i, v in rows
            if v and all(c is not None and math.isfinite(c) for c in v)]
    fit = sorted({v for _, v in kept})
    n, d = len(fit), len(fit[0])
    sums = [sum(v[j] for v in fit) for j in range(d)]
    centred = np.array([[(n * v[j] - sums[j]) / n for j in range(d)] for v in fit])
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components]
    out = {}
    for i, v in kept:
        deviation = sum((n * x - s) ** 2 for x, s in zip(v, sums, strict=True))
        scores = np.array([(n * x - s) / n for x, s in zip(v, sums, strict=True)]) @ vectors / np.sqrt(values)
        out.setdefault(i, []).append((n, deviation, np.abs(scores), values / np.trace(centred.T @ centred / n)))
    return out


def test_equals_brute_force(spark):
    rng = np.random.default_rng(4)
    base = rng.standard_normal((300, 6)) * [3, 2.5, 2, 1.5, 1, 0.5]
    rows = [(k, [float(c) for c in v]) for k, v in enumerate(base)]
    rows += [(900 + k, rows[0][1]) for k in range(150)]            # copies of one vector
    rows += [(1000, None), (1001, []), (1002, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (1003, [math.nan] * 6), (1004, [math.inf, 0.0, 0.0, 0.0, 0.0, 0.0]), (None, rows[1][1])]
    random.Random(2).shuffle(rows)
    df = spark.createDataFrame([(i, v, 0, "x", 1, "y") for i, v in rows], SCHEMA).repartition(5)
    got = whitening.whitened(df, components=4, carry=["vec_id", "component", "n", "row"]).select(
        "row.vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error").collect()
    want = brute_force(rows, 4)
    assert len(got) == 4 * sum(map(len, want.values()))
    for r in got:
        n, deviation, scores, explained = want[r.vec_id][0]
        assert (r.n, r.deviation) == (n, deviation)
        assert abs(abs(r.whitened) - scores[r.component - 1]) < 1e-9
        assert abs(r.explained - explained[r.component - 1]) < 1e-12
        assert r.identity_error < 1e-9


@pytest.mark.parametrize("rows, dims, parts", [
    ([], 0, 0), ([(1, None)], 0, 0), ([(1, [1.0, 2.0])] * 3, 0, 0),       # nothing, nothing usable, one distinct vector
    ([(1, [1.0, 2.0]), (2, [2.0, 2.0])], 1, 2),                           # one direction only
    ([(1, [1.0, 2.0]), (2, [2.0, 5.0]), (3, [0.0, 1.0]), (4, [1.0]), (5, [1.0, 2.0, 3.0])], 2, 3),
])
def test_odd_tables(spark, rows, dims, parts):
    df = spark.createDataFrame([(i, v, 0, "x", 1, "y") for i, v in rows], SCHEMA)
    got = whitening.whitened(df, carry=["vec_id"]).collect()
    assert len(got) == dims * parts
    assert all(r.component <= dims and r.n == parts for r in got)


def test_large_entries(spark):
    rows = [(1, [3e38, 1.0]), (2, [-3e38, 2.0]), (3, [1e12, 3.0]), (4, [0.0, -7.0])]
    df = spark.createDataFrame([(i, v, 0, "x", 1, "y") for i, v in rows], SCHEMA)
    got = {(r.row.vec_id, r.component): r for r in whitening.whitened(df, carry=["vec_id"]).collect()}
    assert got[4, 1].deviation is None and got[4, 1].n == 4
    assert math.isfinite(got[1, 1].whitened)
