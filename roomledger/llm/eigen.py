"""Leading eigenpairs of a symmetric matrix of a few thousand rows at most.

Householder reflections make the matrix tridiagonal, Sturm counts bisect to
its leading eigenvalues, inverse iteration finds their vectors, and vectors of
neighbouring eigenvalues are kept orthogonal to each other.
"""

from __future__ import annotations

import numpy as np

EPS = np.finfo(np.float64).eps
CLUSTER = 1e-3  # eigenvalues closer than this share of the norm are one cluster
ROUNDS = 5
HALVINGS = 128  # more than a double has bits, from any interval


def tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Diagonal, off-diagonal, and the unit vectors of the reflections, in their order."""
    a = matrix.copy()
    reflections = []
    for k in range(len(a) - 2):
        v = a[k + 1:, k].copy()
        length = np.linalg.norm(v)
        if length > 0:
            v[0] += length if v[0] >= 0 else -length
            v /= np.linalg.norm(v)
            rest = a[k + 1:, k + 1:]
            p = rest @ v
            w = p - (p @ v) * v
            rest -= 2 * (np.outer(v, w) + np.outer(w, v))
            a[k + 1:, k] -= 2 * v * (v @ a[k + 1:, k])
        reflections.append(v)
    return np.diag(a).copy(), np.diag(a, -1).copy(), reflections


def count_below(diagonal: np.ndarray, off: np.ndarray, at: np.ndarray) -> np.ndarray:
    """How many eigenvalues lie below each of the points ``at``: negative terms of the Sturm sequence."""
    least = np.finfo(np.float64).tiny / EPS
    found = np.zeros(len(at), np.int64)
    term = np.ones(len(at))
    for k, d in enumerate(diagonal):
        term = d - at - (off[k - 1] ** 2 / term if k else 0.0)
        term = np.where(np.abs(term) < least, -least, term)
        found += term < 0
    return found


def leading_eigenvalues(diagonal: np.ndarray, off: np.ndarray, k: int) -> np.ndarray:
    """The ``k`` largest eigenvalues, falling, each bisected down to neighbouring doubles."""
    n = len(diagonal)
    reach = np.concatenate(([0.0], np.abs(off))) + np.concatenate((np.abs(off), [0.0]))
    margin = 2 * n * EPS * np.abs(diagonal).max() + np.finfo(np.float64).tiny
    low = np.full(k, (diagonal - reach).min() - margin)
    high = np.full(k, (diagonal + reach).max() + margin)
    ascending = n - 1 - np.arange(k)
    for _ in range(HALVINGS):
        middle = low + (high - low) / 2
        if ((middle <= low) | (middle >= high)).all():
            break
        above = count_below(diagonal, off, middle) <= ascending
        low, high = np.where(above, middle, low), np.where(above, high, middle)
    return low + (high - low) / 2


def _factors(diagonal: list[float], off: list[float], at: float, least: float) -> list[tuple[float, float, float, float, bool]]:
    """Rows of the elimination of T - at with row exchanges: pivot, its next two entries, the multiplier, and if rows changed place."""
    rows = []
    n = len(diagonal)
    here, right, far = diagonal[0] - at, off[0] if n > 1 else 0.0, 0.0
    for k in range(n - 1):
        below, below_here = off[k], diagonal[k + 1] - at
        below_right = off[k + 1] if k + 2 < n else 0.0
        if abs(here) >= abs(below):
            pivot = here if abs(here) > least else least
            factor = below / pivot
            rows.append((pivot, right, far, factor, False))
            here, right, far = below_here - factor * right, below_right - factor * far, 0.0
        else:
            factor = here / below
            rows.append((below, below_here, below_right, factor, True))
            here, right, far = right - factor * below_here, far - factor * below_right, 0.0
    rows.append((here if abs(here) > least else least, 0.0, 0.0, 0.0, False))
    return rows


def _solved(rows: list[tuple[float, float, float, float, bool]], right: np.ndarray) -> np.ndarray:
    x = right.tolist()
    n = len(x)
    for k in range(n - 1):
        if rows[k][4]:
            x[k], x[k + 1] = x[k + 1], x[k]
        x[k + 1] -= rows[k][3] * x[k]
    for k in range(n - 1, -1, -1):
        if k + 1 < n:
            x[k] -= rows[k][1] * x[k + 1]
        if k + 2 < n:
            x[k] -= rows[k][2] * x[k + 2]
        x[k] /= rows[k][0]
    return np.array(x)


def tridiagonal_vectors(diagonal: np.ndarray, off: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Unit eigenvectors in columns, by inverse iteration; ``values`` fall."""
    n = len(diagonal)
    norm = max(np.abs(diagonal).max(), np.abs(off).max() if n > 1 else 0.0)
    start = np.random.default_rng(0)
    vectors = np.zeros((n, len(values)))
    first, at = 0, np.inf
    for j, value in enumerate(values):
        if j and values[j - 1] - value > CLUSTER * norm:
            first = j
        # Equal eigenvalues are moved apart by less than they are known to, or both would be given the same vector.
        at = min(value, at - 10 * EPS * norm)
        rows = _factors(diagonal.tolist(), off.tolist(), float(at), EPS * norm)
        x = start.standard_normal(n)
        for _ in range(ROUNDS):
            x = _solved(rows, x / np.linalg.norm(x))
            x /= np.abs(x).max()
            for _ in range(2):
                for i in range(first, j):
                    x -= (vectors[:, i] @ x) * vectors[:, i]
        vectors[:, j] = x / np.linalg.norm(x)
    return vectors


def leading_eigenpairs(matrix: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest eigenvalues, falling, and their unit vectors in columns; the largest entry of a vector is positive."""
    n = len(matrix)
    scale = float(np.abs(matrix).max()) if n else 0.0
    if scale == 0.0:
        return np.zeros(0), np.zeros((n, 0))
    diagonal, off, reflections = tridiagonal((matrix + matrix.T) / (2 * scale))
    values = leading_eigenvalues(diagonal, off, min(k, n))
    vectors = tridiagonal_vectors(diagonal, off, values)
    for i in range(len(reflections) - 1, -1, -1):
        v = reflections[i]
        vectors[i + 1:] -= 2 * np.outer(v, v @ vectors[i + 1:])
    vectors /= np.linalg.norm(vectors, axis=0)
    largest = np.abs(vectors).argmax(axis=0)
    return values * scale, vectors * np.sign(vectors[largest, np.arange(vectors.shape[1])])
