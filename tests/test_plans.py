"""Properties of physical plans that the design relies on at scale."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidelake.operators import asof, dedup, gaps, incremental, lagging
from tidelake.operators.bars import trade_bars
from tidelake.plans import gold
from test_gold import TWO, raw_inputs  # noqa: I001


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def observations(spark):
    return spark.createDataFrame([], "exchange string, symbol string, t timestamp, i timestamp, v double")


def test_keep_latest_drops_rows_before_the_shuffle(spark):
    text = plan(dedup.keep_latest(observations(spark), ["symbol", "t"], ["i"]))
    assert text.index("Final") < text.index("Exchange") < text.index("Partial")


def test_bars_are_aggregated_before_the_shuffle(spark):
    ticks = spark.createDataFrame(
        [], "trade_time timestamp, exchange string, symbol string, instrument_type string, trade_id string, price double, quantity double, side string"
    )
    text = plan(trade_bars(ticks))
    assert text.count("Exchange") == 1
    assert text.index("Exchange") < text.index("partial_sum")


def test_asof_moves_only_reduced_observations(spark):
    text = plan(asof.minute_asof(observations(spark), ["exchange", "symbol"], "t", ["v"], ["i"]))
    assert "Join" not in text
    # calendar minutes are made above the last exchange, and no shuffle follows
    assert text.index("explode(sequence") < text.index("Exchange")
    assert text.count("Exchange") == 2


def test_gold_joins_do_not_copy_the_grid_into_scans(spark, tmp_path):
    from tidelake.sources import lake

    raw = raw_inputs(spark, "gold.market.full.m1", TWO)
    for n, frame in raw.items():
        time = {"spot": "open_time", "perp": "open_time", "funding_1m_feature": "timestamp"}.get(n, "timestamp_m1")
        lake.write_silver(frame, str(tmp_path), n, "1m", time)
    stored = {n: lake.read_silver(spark, str(tmp_path), n, "1m") for n in raw}
    text = plan(gold.gold_frame(stored, "gold.market.full.m1"))
    assert "dynamicpruning" not in text
    assert text.count("FileScan parquet") == len(raw) + 1  # every input once, and the spans
    assert "CartesianProduct" not in text and "NestedLoop" not in text


def test_gaps_read_their_input_once(spark):
    times = spark.createDataFrame([("a", 0), ("a", 600_000), ("b", 86_400_000)], "s string, ms bigint")
    found = gaps.gap_ranges(times.repartition(2, "s"), ["s"], "ms", 60_000, 90_000_000)
    found.collect()
    assert "ReusedExchange" in plan(found)


def test_gap_fill_is_an_equality_join(spark):
    times = spark.createDataFrame([], "s string, ms bigint")
    text = plan(incremental.full_gap_fill(times, times, ["s"], "ms", 60_000, 10, F.lit(None).cast("bigint")))
    assert "CartesianProduct" not in text and "NestedLoop" not in text


def test_previous_rows_read_their_input_once(spark):
    bars = spark.range(5000).selectExpr("'a' AS s", "timestamp_seconds(id * 60) AS t", "cast(id % 7 AS double) AS v", "id AS extra")
    reduced = bars.groupBy("s", "t", "extra").agg(F.max("v").alias("v"))
    up = lagging.price_direction(reduced, ["s"], "t", "v")
    assert up.where("NOT is_up").count() == 5000 // 7
    up.collect()
    final = plan(up).split("== Initial Plan ==")[0]
    assert final.count("Range (") == 1 and "ReusedExchange" in final
