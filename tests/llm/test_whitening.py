"""Whitening against a full eigendecomposition."""

from __future__ import annotations

import math

import numpy as np
import pytest

from tidelake.llm import whitening as wh
from tidelake.llm.base import ship

SCHEMA = "vec_id long, embedding array<float>"


def brute(rows, k):
    """Per key: n, deviation, whitened with a sign fixed by its largest entry, explained."""
    kept = [(i, [math.floor(1024 * float(np.float32(c))) + 100_000 for c in v]) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    x = np.array([v for _, v in kept], object)
    n, s = len(x), x.sum(axis=0)
    y = ((n * x - s) / n).astype(float)
    v = y.T @ y / n
    values, vectors = np.linalg.eigh(v)
    order = np.argsort(-values)[:k]
    white = y @ vectors[:, order] / np.sqrt(values[order])
    return [(key, n, int(sum((n * a - b) ** 2 for a, b in zip(row, s))), w, values[order] / np.trace(v)) for (key, _), row, w in zip(kept, x, white)]


def check(spark, rows, k, expected_components):
    ship(spark)
    got = wh.whiten(spark.createDataFrame(rows, SCHEMA).repartition(3), "embedding", k).collect()
    wanted = brute(rows, expected_components)
    assert len(got) == len(wanted) * expected_components
    assert {r.n for r in got} == {len(wanted)} and max(r.identity_error for r in got) < 1e-6
    by_key = {}
    for r in got:
        by_key.setdefault(r.vec_id, {})[r.component] = r
    signs = None
    for key, n, deviation, white, explained in wanted:
        mine = np.array([by_key[key][c].whitened for c in range(1, expected_components + 1)])
        if signs is None:
            signs = np.sign(mine * white)
        assert np.allclose(mine * signs, white, atol=1e-8)
        assert {by_key[key][c].deviation for c in by_key[key]} == {deviation}
        assert np.allclose([by_key[key][c].explained for c in range(1, expected_components + 1)], explained, rtol=1e-10)


def vectors(n, dims, seed, spread=1.0):
    rng = np.random.default_rng(seed)
    scale = np.linspace(1, 1 + spread, dims)
    return [(i, (rng.normal(size=dims) * scale).astype(np.float32).tolist()) for i in range(n)]


def test_against_a_full_decomposition(spark):
    check(spark, vectors(400, 20, 1), 8, 8)


def test_close_eigenvalues(spark):
    check(spark, vectors(3000, 24, 2, 0.01), 8, 8)


def test_fewer_dimensions_than_components(spark):
    check(spark, vectors(50, 3, 3), 8, 3)


def test_rows_left_out_and_vanishing_components(spark):
    rows = [(i, [a, 2 * a, b, 0.5]) for i, (a, b) in enumerate(np.random.default_rng(4).integers(-9, 9, (60, 2)).tolist())]
    rows = [(i, [float(c) for c in v]) for i, v in rows]
    bad = [(100, None), (101, [1.0, None, 1.0, 1.0]), (102, [float("nan"), 1.0, 1.0, 1.0]), (103, [1.0, float("-inf"), 1.0, 1.0])]
    # One dimension is twice another and one is constant: two components are left.
    check(spark, rows + bad, 8, 2)


def test_one_vector_held_by_a_third(spark):
    rows = vectors(300, 10, 5)
    check(spark, [(i, rows[0][1] if i % 3 == 0 else v) for i, v in rows], 4, 4)


def test_no_variance_no_rows_and_empty_tables(spark):
    ship(spark)
    for rows in ([], [(1, None)], [(1, [1.0, 2.0])], [(i, [1.0, 2.0]) for i in range(5)], [(1, [])]):
        got = wh.whiten(spark.createDataFrame(rows, SCHEMA), "embedding")
        assert got.count() == 0 and got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def test_null_and_repeated_keys_and_clashing_names(spark):
    ship(spark)
    rows = [(None, [1.0, 0.0], 1, 2, 3, 4), (None, [1.0, 0.0], 1, 2, 3, 4), ("a", [0.0, 3.0], 1, 2, 3, 4)]
    frame = spark.createDataFrame(rows, "vec_id string, v array<double>, N int, x int, kept int, w int")
    got = wh.whiten(frame, "v", 1)
    assert got.columns == ["vec_id", "x", "kept", "w", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    assert sorted((str(r.vec_id), r.x, r.kept, r.w, r.n) for r in got.collect()) == [("None", 2, 3, 4, 3)] * 2 + [("a", 2, 3, 4, 3)]


def test_vectors_of_different_lengths_raise(spark):
    ship(spark)
    with pytest.raises(Exception, match="components in one table|different lengths"):
        wh.whiten(spark.createDataFrame([(1, [1.0]), (2, [1.0, 2.0]), (3, [4.0])], SCHEMA), "embedding").count()


def symmetric(values, seed=0):
    q, _ = np.linalg.qr(np.random.default_rng(seed).normal(size=(len(values), len(values))))
    return q @ np.diag(values) @ q.T


@pytest.mark.parametrize("values", [
    [5.0] * 12, [3.0] * 3 + [1.0] * 30, np.linspace(1, 2, 40), 2.0 ** -np.arange(40), [1.0, 1 - 1e-9, 1 - 2e-9] + [0.5] * 20, [1e6] + [1e-3] * 10, [7.0], [4.0, 4.0], [1.0] + [0.0] * 20,
    np.concatenate([np.linspace(1, 1.001, 9), np.linspace(0.99899, 0.999, 20)]),
])
def test_feast_finds_all_of_the_largest(spark, values):
    v = symmetric(np.asarray(values, float))
    v = (v + v.T) / 2
    got, vectors_ = wh.feast(spark, v, 8)
    full = np.sort(np.linalg.eigvalsh(v))[::-1]
    wanted = [x for x in full[:8] if x > wh.FLOOR * full[0]]
    assert np.allclose(got, wanted, atol=1e-12 * full[0])
    assert np.abs(vectors_.T @ vectors_ - np.eye(len(got))).max() < 1e-12
    assert np.abs(v @ vectors_ - vectors_ * got).max() < 1e-12 * full[0]


def test_inertia_counts():
    values = np.array([3.0, 1.0, 1.0, -2.0, 0.5, 8.0])
    diagonal, off = wh.tridiagonal(symmetric(values))
    shifts = np.array([-3.0, -1.0, 0.7, 2.0, 5.0, 9.0])
    assert wh.count_above(diagonal, off, shifts).tolist() == [(values > s).sum() for s in shifts]


def test_deviations_beyond_64_bits_are_exact_or_raise():
    x = np.array([[100_000, 5], [100_003, 7]])
    assert wh.deviations(x, 2, x.astype(object).sum(axis=0)).tolist() == [13, 13]
    n = 3_000_000_000
    x = np.array([[2, 0], [1, 0]])
    assert wh.deviations(x, n, np.array([2 * n - 1, 1], object)).tolist() == [2, (1 - n) ** 2 + 1]
    with pytest.raises(OverflowError):
        wh.deviations(np.array([[10]]), n, np.array([0], object))
