from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from roomledger.llm import eigen, whitening


@pytest.mark.parametrize("n", [1, 2, 3, 7, 64, 150])
@pytest.mark.parametrize("kind", ["any", "identity", "cluster", "equal", "blocks", "zero", "near"])
def test_leading_eigenpairs(n, kind):
    rng = np.random.default_rng(n)
    a = rng.standard_normal((n, n))
    a = a @ a.T
    turn, _ = np.linalg.qr(a)
    if kind == "identity":
        a = 3e9 * np.eye(n)
    elif kind == "cluster":
        a = turn @ np.diag(np.r_[np.full(n // 2, 5.0), np.linspace(1, 2, n - n // 2)]) @ turn.T
    elif kind == "equal":
        a = np.diag(np.repeat([7.0, 7.0, 3.0], n)[:n])
    elif kind == "blocks":
        a[:n // 2, n // 2:] = a[n // 2:, :n // 2] = 0
    elif kind == "zero":
        a[:] = 0
    elif kind == "near":
        a = turn @ np.diag(1 + 1e-13 * np.arange(n)) @ turn.T
    values, vectors = eigen.leading_eigenpairs(a, 32)
    if kind == "zero":
        assert len(values) == 0
        return
    want = np.linalg.eigvalsh(a)[::-1][:32]
    scale = np.abs(want).max()
    assert np.abs(values - want).max() <= 1e-14 * n * scale and (np.diff(values) <= 0).all()
    assert np.abs(a @ vectors - vectors * values).max() <= 1e-14 * n * scale
    assert np.abs(vectors.T @ vectors - np.eye(len(values))).max() <= 1e-13


def test_sturm_counts():
    diagonal, off = np.array([1.0, 4.0, 2.0, 2.0]), np.array([0.5, 0.0, 1.0])
    values = np.linalg.eigvalsh(np.diag(diagonal) + np.diag(off, 1) + np.diag(off, -1))
    at = np.linspace(-1, 6, 71) + 1e-4
    assert (eigen.count_below(diagonal, off, at) == [(values < x).sum() for x in at]).all()


def brute(vectors: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """Whole-number rows, eigenvalues, unit eigenvectors and the trace, by the library's solver."""
    x = np.floor(64 * vectors.astype(np.float64)).astype(np.int64) + 1000000
    centred = x - x.mean(axis=0)
    covariance = centred.T @ centred / len(x)
    values, found = np.linalg.eigh(covariance)
    return x, values[::-1][:k], found[:, ::-1][:, :k], float(np.trace(covariance))


def same_as_brute(rows, vectors: np.ndarray, k: int = 32) -> None:
    """``rows`` of ``whitened_components`` whose vec_id is the row of ``vectors``."""
    x, values, unit, trace = brute(vectors, k)
    n, d = x.shape
    assert len(rows) == n * min(k, d)
    found = np.zeros((n, min(k, d)))
    total = x.sum(axis=0)
    for r in rows:
        found[r.vec_id, r.component - 1] = r.whitened
        assert r.n == n and abs(r.explained - values[r.component - 1] / trace) <= 1e-9 * r.explained
        assert r.deviation == sum((n * int(a) - int(s)) ** 2 for a, s in zip(x[r.vec_id], total))
        assert r.identity_error <= 1e-9
    want = (x - x.mean(axis=0)) @ unit / np.sqrt(values)
    want *= np.sign((want * found).sum(axis=0))
    assert np.abs(found - want).max() <= 1e-6
    assert np.abs(found.T @ found / n - np.eye(min(k, d))).max() <= 1e-9


def test_given_embeddings_equal_brute_force(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").orderBy("vec_id")
    vectors = np.array([r.embedding for r in table.collect()], np.float32)
    numbered = spark.createDataFrame(
        [(k, [float(c) for c in v], 0) for k, v in enumerate(vectors)], "vec_id long, embedding array<float>, label int"
    )
    same_as_brute(whitening.whitened_components(numbered.repartition(5)).collect(), vectors)


def test_messy_rows(spark):
    rng = np.random.default_rng(3)
    vectors = rng.standard_normal((40, 6)).astype(np.float32)
    vectors[1] = vectors[0]  # a repeated row
    vectors[:, 4] *= 1000
    bad = [None, [], [1.0], [None] + [0.0] * 5, [float("nan")] + [0.0] * 5, [float("inf")] + [0.0] * 5, [float("-inf")] * 6]
    own = ["n", "deviation", "whitened", "explained", "identity_error"]
    schema = "vec_id long, embedding array<float>, label int, " + ", ".join(f"{c} string" for c in own) + ", count string, at string"
    extra = ["x"] * 7
    rows = [(k, [float(c) for c in v], 1, *extra) for k, v in enumerate(vectors)] + [(100 + k, v, None, *extra) for k, v in enumerate(bad)]
    table = spark.createDataFrame(rows, schema)
    same_as_brute(whitening.whitened_components(table).collect(), vectors)
    kept = whitening.whiten(table)
    assert kept.columns == ["vec_id", "embedding", "label", "count", "at", *own] and kept.count() == 40
    assert whitening.whiten(table.limit(0)).count() == 0
    assert whitening.whiten(table.filter("vec_id >= 100").filter("embedding is null")).count() == 0


def test_without_variance(spark):
    """One row, equal rows, constant and dependent dimensions: only components with variance are given."""
    def components(vectors):
        rows = [(None, v) for v in vectors]
        found = whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
        return [len(r.whitened) for r in found], [r.deviation for r in found], {r.identity_error for r in found}

    assert components([[1.0, 2.0]]) == ([0], [0], {None})
    assert components([[1.0, 2.0]] * 3) == ([0] * 3, [0] * 3, {None})
    lengths, deviations, errors = components([[float(k), 2.0 * k, 5.0] for k in range(4)])
    assert lengths == [1] * 4 and max(errors) < 1e-12
    assert deviations == [(4 * 64 * k - 6 * 64) ** 2 * 5 for k in range(4)]


def test_sums_stay_exact_for_large_entries(spark):
    big = [[1e12 + k / 64, float(k)] for k in range(5)]
    found = whitening.whiten(spark.createDataFrame([(k, v) for k, v in enumerate(big)], "vec_id long, embedding array<double>"))
    assert {r.vec_id: r.deviation for r in found.collect()} == {k: (5 * k - 10) ** 2 * (1 + 64**2) for k in range(5)}
    wide = [[1e13, 0.0], [-1e13, 1.0], [0.0, 3.0]]
    found = whitening.whiten(spark.createDataFrame([(k, v) for k, v in enumerate(wide)], "vec_id long, embedding array<double>"))
    assert {r.vec_id: r.deviation is None for r in found.collect()} == {0: True, 1: True, 2: False}
    assert found.select(F.max("identity_error")).first()[0] < 1e-4
