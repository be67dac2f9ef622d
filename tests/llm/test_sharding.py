"""Rendezvous shards and slots."""

from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidelake.llm import sharding


def placed(spark, keys, *shards):
    df = spark.createDataFrame([(k,) for k in keys], "id long")
    return sharding.rendezvous_shards(df, "id", *shards).collect()


def test_a_new_shard_only_takes(spark):
    rows = placed(spark, range(4000), 10, 11)
    assert all(r.grown_shard in (r.shard, 10) for r in rows)
    moved = sum(r.grown_shard != r.shard for r in rows)
    assert 250 < moved < 480
    assert min(Counter(r.shard for r in rows).values()) > 300


def test_a_shard_that_leaves_only_gives(spark):
    rows = placed(spark, range(2000), [1, 2, 3, 4], [1, 2, 4])
    assert all(r.shard == r.grown_shard for r in rows if r.shard != 3)


def test_weights(spark):
    counts = Counter(r.shard for r in placed(spark, range(6000), {0: 1.0, 1: 2.0, 5: 3.0}))
    assert set(counts) == {0, 1, 5}
    assert abs(counts[1] / 6000 - 1 / 3) < 0.03 and abs(counts[5] / 6000 - 1 / 2) < 0.03


def test_bad_weights():
    for wrong in ({}, {0: 0.0}, {0: -1.0}, 0):
        with pytest.raises(ValueError):
            sharding.shard_weights(wrong)


def test_slots_are_gapless_with_nulls_and_repeats(spark):
    keys = [None] * 5 + [7] * 40 + list(range(200))
    df = spark.createDataFrame([(k, "x" * (i % 3)) for i, k in enumerate(keys)], "id long, text string")
    got = sharding.with_slots(sharding.rendezvous_shards(df, "id", 4), ["id", "text"], digits=1).collect()
    assert len(got) == len(keys)
    by_shard: dict[int, list[int]] = {}
    for r in got:
        by_shard.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(v) == list(range(len(v))) for v in by_shard.values())
    assert len({r.shard for r in got if r.id is None}) == 1


def test_empty_table_and_clashing_names(spark):
    df = spark.createDataFrame([], "id long, shard string, slot string")
    out = sharding.with_slots(sharding.rendezvous_shards(df, "id", 3), ["id"])
    assert out.collect() == []
    one = spark.createDataFrame([(1, "old", "old")], "id long, shard string, slot string")
    row = sharding.with_slots(sharding.rendezvous_shards(one, "id", 3), ["id"]).first()
    assert row.shard in (0, 1, 2) and row.slot == 0


def test_rows_alike_are_numbered_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(sharding, "PIECE_BITS", 5)
    keys = [None] * 700 + [7] * 900 + list(range(1000, 1400))
    df = spark.createDataFrame([(k, None if k is None else "x") for k in keys], "id long, text string").repartition(3)
    placed_ = sharding.rendezvous_shards(df, "id", 3)
    frame = sharding.with_slots(placed_, ["id", "text"])
    got = frame.collect()
    assert len(got) == len(keys)
    for shard in range(3):
        own = [r for r in got if r.shard == shard]
        assert sorted(r.slot for r in own) == list(range(len(own)))
        # Each bucket is in order, so the rows alike have neighbouring slots.
        for k, count in ((None, 700), (7, 900)):
            mine = sorted(r.slot for r in own if r.id == k)
            assert not mine or mine == list(range(mine[0], mine[0] + count))
    assert "_alike" in frame._jdf.queryExecution().analyzed().toString()


def test_helper_names_clash_with_nothing(spark):
    names = ["id", "_row", "_bucket", "_start", "_n", "_piece", "_alike", "Slot"]
    df = spark.createDataFrame([(i % 3, 1, 2, 3, 4, 5, 6, 7) for i in range(30)], ", ".join(f"{n} long" for n in names))
    out = sharding.with_slots(sharding.rendezvous_shards(df, "id", 2), ["id", "_row"])
    assert out.columns == [*names[:-1], "shard", "slot"] and out.count() == 30


def test_no_python_in_the_plan(spark):
    df = sharding.rendezvous_shards(spark.range(10), "id", 40, 41)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan
    assert df.select(F.max("shard")).first()[0] < 40
