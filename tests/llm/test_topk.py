"""Histogram selection against a full comparison."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidelake.llm import topk
from tidelake.llm.base import settle, ship


def brute(rows, k, scale=64):
    points = [(i, [math.floor(scale * x) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    asked: dict[int, list[int]] = {}
    for i, v in points:
        if i % 20 == 0:
            asked[i] = min(asked.get(i, v), v)
    out = []
    for q, qv in asked.items():
        scores = sorted((-sum(a * b for a, b in zip(qv, v)), i) for i, v in points if i != q)[:k]
        out += [(q, rank, i, -s) for rank, (s, i) in enumerate(scores, 1)]
    return sorted(out)


def run(spark, rows, k, schema="vec_id long, embedding array<float>"):
    ship(spark)
    df = spark.createDataFrame(rows, schema)
    return sorted(tuple(r) for r in topk.inner_product_topk(df, "vec_id", "embedding", F.col("vec_id") % 20 == 0, k).collect())


def vectors(n, dims, seed, digits=1):
    rng = np.random.default_rng(seed)
    return [(i, np.round(rng.normal(size=dims), digits).astype(np.float32).tolist()) for i in range(n)]


def test_against_brute_force_with_many_ties(spark):
    rows = vectors(300, 3, 1, 0)
    assert run(spark, rows, 20) == brute(rows, 20)


def test_one_vector_held_by_a_third(spark):
    rows = [(i, [1.0, 0.5]) if i % 3 == 0 else r for i, r in enumerate(vectors(240, 2, 2)) for r in [r]]
    assert run(spark, rows, 7) == brute(rows, 7)


def test_null_and_unfit_vectors_take_no_part(spark):
    rows = [(0, [1.0, 2.0]), (1, None), (2, [1.0, None]), (3, [float("nan"), 0.0]), (4, [float("inf"), 0.0]), (None, [9.0, 9.0]), (5, [0.5, -1.0]), (20, [0.1, 0.1])]
    assert run(spark, rows, 3) == brute(rows, 3)


def test_large_components_stay_exact(spark):
    rows = [(i, [float(2**22 + i), float(3 * i - 2**21)]) for i in range(45)]
    assert run(spark, rows, 5, "vec_id long, embedding array<double>") == brute(rows, 5)


def test_products_beyond_a_long_raise(spark):
    with pytest.raises(ValueError):
        run(spark, [(0, [1e30]), (1, [1e30])], 1, "vec_id long, embedding array<double>")


def test_few_rows_repeats_and_extra_columns(spark):
    rows = [(20, [1.0], "a"), (20, [0.5], "b"), (7, [2.0], "c"), (7, [2.0], "c")]
    got = run(spark, rows, 20, "vec_id long, embedding array<float>, score string")
    assert got == [(20, 1, 7, 4096), (20, 2, 7, 4096)]


def test_empty_and_lonely(spark):
    assert run(spark, [], 5) == []
    assert run(spark, [(0, [1.0])], 5) == []
    assert run(spark, [(1, [1.0]), (2, [1.0])], 5) == []
    assert run(spark, [(0, []), (1, [])], 5) == [(0, 1, 1, 0)]


def test_no_block_or_interval_goes_through_the_driver(spark, monkeypatch):
    plans = []
    monkeypatch.setattr(topk, "settle", lambda df, label: plans.append(df) or settle(df, label))
    df = spark.createDataFrame(vectors(60, 2, 3), "vec_id long, embedding array<float>")
    plans.append(topk.inner_product_topk(ship(spark) and df, "vec_id", "embedding", F.col("vec_id") % 20 == 0, 3))
    shown = [p._jdf.queryExecution().executedPlan().toString() for p in plans]
    assert sum("SortMergeJoin" in p for p in shown) >= 2
    assert not any("Broadcast" in p for p in shown)


def test_blocks_are_copied_as_often_as_tasks_need_them():
    assert topk._groups(1, 1, 600) == (1, 1)
    for rows, queries, tasks in [(0, 0, 4), (27, 6, 600), (312, 66, 600), (312, 66, 19), (9000, 2000, 600), (3, 500, 8), (500, 1, 8)]:
        g, h = topk._groups(rows, queries, tasks)
        assert 1 <= g <= max(1, rows) and 1 <= h <= max(1, queries) and queries <= topk.QUERY_GROUP * h
        assert g * h >= min(4 * tasks, rows * queries)
    g, h = topk._groups(312, 66, 600)
    copied, once_with_all_rows = 312 * 2048 * h + 66 * 512 * g, 312 * 2048 + 66 * 512 * 1200
    assert copied < 0.4 * once_with_all_rows
