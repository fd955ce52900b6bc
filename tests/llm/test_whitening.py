"""Whitening against numpy on whole tables, exact integer sums, and tables with nulls, odd lengths and repeats."""

from __future__ import annotations

import math

import numpy as np
import pytest

from tallyloom.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, component int, vector string"


@pytest.mark.parametrize("n", [1, 2, 3, 10, 65])
def test_eigenvectors(n):
    rng = np.random.default_rng(n)
    base = rng.standard_normal((n, n))
    ones = np.linalg.qr(base)[0]
    for matrix in (base @ base.T, np.eye(n), np.zeros((n, n)), np.ones((n, n)), ones @ np.diag([*[2.0] * (n // 2), *[1.0] * (n - n // 2)]) @ ones.T, np.diag(1 + 1e-13 * np.arange(n)), (base @ base.T) * 1e12):
        matrix = (matrix + matrix.T) / 2
        values, vectors = whitening.leading_eigenvectors(matrix, 32)
        size = (np.abs(matrix).max() or 1.0) * n
        want = np.linalg.eigvalsh(matrix)[::-1][:32]
        assert np.allclose(values, want, rtol=0, atol=1e-14 * size)
        assert np.allclose(vectors.T @ vectors, np.eye(len(values)), atol=1e-13)
        assert np.abs(matrix @ vectors - vectors * values).max() <= 1e-13 * size


def brute(rows, components=32):
    """(n, deviations by row, absolute whitened values, explained) by numpy and Python's own integers."""
    x = [[math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v] for _, v in rows]
    n = len(x)
    sums = [sum(c) for c in zip(*x, strict=True)]
    deviations = [sum((n * c - s) ** 2 for c, s in zip(v, sums, strict=True)) for v in x]
    centred = np.array([[(n * c - s) / n for c, s in zip(v, sums, strict=True)] for v in x])
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components]
    return n, deviations, np.abs(centred @ vectors / np.sqrt(values)), values / centred.var(axis=0).sum()


def test_whitening_equals_numpy(spark):
    rng = np.random.default_rng(2)
    table = [(i, [float(c) for c in v]) for i, v in enumerate((rng.standard_normal((300, 12)) * np.arange(1, 13)).astype(np.float32))]
    table += [(7, table[7][1]), (None, table[8][1])]
    odd = [(900, None), (901, []), (902, [None] * 12), (903, [float("nan")] * 12), (904, [float("inf")] + [0.0] * 11), (905, [1.0] * 5)]
    docs = spark.createDataFrame([(i, v, 1, "x") for i, v in table + odd], SCHEMA).repartition(7)
    for components in (32, 5):
        n, deviations, whitened, explained = brute(table, components)
        got = whitening.whiten(docs, components).collect()
        assert len(got) == n * min(components, 12)
        assert {r.n for r in got} == {n} and {r.component for r in got} == set(range(1, min(components, 12) + 1))
        assert len({r.identity_error for r in got}) == 1 and got[0].identity_error < 1e-10
        want = sorted((i is None, i or 0, c + 1, deviations[k], whitened[k][c]) for k, (i, _) in enumerate(table) for c in range(min(components, 12)))
        have = sorted((r.vec_id is None, r.vec_id or 0, r.component, r.deviation, abs(r.whitened)) for r in got)
        assert [h[:4] for h in have] == [w[:4] for w in want]
        assert np.allclose([h[4] for h in have], [w[4] for w in want], atol=1e-9)
        assert all(abs(r.explained - explained[r.component - 1]) < 1e-12 for r in got)


def test_whitening_without_variance_or_rows(spark):
    assert whitening.whiten(spark.createDataFrame([], SCHEMA)).collect() == []
    assert whitening.whiten(spark.createDataFrame([(1, None, 1, "x"), (2, [None], 1, "x")], SCHEMA)).collect() == []
    assert whitening.whiten(spark.createDataFrame([(i, [1.0, 2.0], 1, "x") for i in range(5)], SCHEMA)).collect() == []
    # three rows of eight dimensions span two; the same vector many times over is kept as often
    rows = [(i, [float(i == k) for k in range(8)], 1, "x") for i in range(3)] * 4
    got = whitening.whiten(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(got) == 24 and {r.component for r in got} == {1, 2} and got[0].identity_error < 1e-10
    far = spark.createDataFrame([(1, [3e38, 1.0], 1, "x"), (2, [-3e38, 2.0], 1, "x"), (3, [0.0, 0.0], 1, "x")], SCHEMA)
    assert {r.deviation for r in whitening.whiten(far).where("vec_id < 3").collect()} == {None}
