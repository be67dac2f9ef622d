from __future__ import annotations

import random
from datetime import date, timedelta

import pytest
from conftest import ms, ts
from helpers import rows
from pyspark.sql import functions as F

from tidelake.operators import gaps, incremental, lagging, planning, profile, quality

MINUTE = 60_000


def times(spark, values):
    return spark.createDataFrame([("a", v) for v in values], "s string, ms bigint")


def slow_gaps(values, interval, end):
    have = sorted({v for v in values if v <= end})
    found = [(p + interval, c - interval) for p, c in zip(have, have[1:], strict=False) if p + interval <= c - interval]
    if have and have[-1] + interval <= end:
        found.append((have[-1] + interval, end))
    return sorted(found)


def test_gap_example(spark):
    have = [ms(f"2026-01-01 10:0{m}:00") for m in (0, 2, 3)]
    found = gaps.gap_ranges(times(spark, have), ["s"], "ms", MINUTE, ms("2026-01-01 10:05:00"))
    assert rows(found, "start_ms", "end_ms") == [
        (ms("2026-01-01 10:01:00"), ms("2026-01-01 10:01:00")),
        (ms("2026-01-01 10:04:00"), ms("2026-01-01 10:05:00")),
    ]
    assert gaps.gap_ranges(times(spark, []), ["s"], "ms", MINUTE, 0).count() == 0
    late = times(spark, [ms("2026-01-01 11:00:00")])
    assert gaps.gap_ranges(late, ["s"], "ms", MINUTE, ms("2026-01-01 10:05:00")).count() == 0


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_gaps_of_unaligned_times_equal_the_plain_scan(spark, seed):
    random.seed(seed)
    start = ms("2026-01-01 22:00:00")
    values = [start + random.randrange(0, 4 * 3_600_000) for _ in range(150)]
    end = start + 3 * 3_600_000
    found = gaps.gap_ranges(times(spark, values), ["s"], "ms", MINUTE, end)
    assert sorted(rows(found, "start_ms", "end_ms")) == slow_gaps(values, MINUTE, end)


def test_head_gap(spark):
    have = times(spark, [ms("2026-01-01 00:03:00")])
    found = gaps.head_gap(have, ["s"], "ms", MINUTE, ms("2026-01-01 01:00:00"), ms("2026-01-01 00:00:00"))
    assert rows(found, "start_ms", "end_ms") == [(ms("2026-01-01 00:00:00"), ms("2026-01-01 00:02:00"))]
    assert gaps.head_gap(have, ["s"], "ms", MINUTE, ms("2026-01-01 01:00:00"), ms("2026-01-01 00:03:00")).count() == 0


def test_split_days(spark):
    one = spark.createDataFrame(
        [("a", ms("2026-01-01 23:59:00"), ms("2026-01-02 00:01:00")), ("b", 5, 4)], "s string, start_ms bigint, end_ms bigint"
    )
    assert rows(gaps.split_utc_days(one), "start_ms", "end_ms") == [
        (ms("2026-01-01 23:59:00"), ms("2026-01-01 23:59:59") + 999),
        (ms("2026-01-02 00:00:00"), ms("2026-01-02 00:01:00")),
    ]


@pytest.mark.parametrize("seed", [1, 2, 3, 4])
@pytest.mark.parametrize("bounded", [True, False])
def test_gap_fill_equals_ranges(spark, seed, bounded):
    random.seed(seed)
    start = ms("2026-01-01 00:00:00")
    stored = [start + random.randrange(600_000, 7_200_000) for _ in range(60)]
    landed = [start + random.randrange(0, 9_000_000) for _ in range(800)]
    end, bound = start + 8_000_000, start + 100_000
    ranges = slow_gaps(stored, MINUTE, end)
    if bounded:
        ranges.append((bound, min(stored) - MINUTE))
    expected = sorted(t for t in landed if any(a <= t <= z for a, z in ranges))
    got = incremental.full_gap_fill(
        times(spark, landed), times(spark, stored), ["s"], "ms", MINUTE, end, F.lit(bound if bounded else None).cast("bigint")
    )
    assert sorted(r.ms for r in got.collect()) == expected


def test_gap_fill_of_an_empty_or_later_series(spark):
    landed = times(spark, [1_000, 100_000, 400_000])
    none, end = times(spark, []), 300_000
    bound = F.lit(50_000).cast("bigint")
    fill = incremental.full_gap_fill(landed, none, ["s"], "ms", MINUTE, end, bound)
    assert rows(fill, "ms") == [(100_000,)]
    everything = incremental.full_gap_fill(landed, none, ["s"], "ms", MINUTE, end, F.lit(None).cast("bigint"))
    assert everything.count() == 3
    later = times(spark, [900_000])
    assert incremental.full_gap_fill(landed, later, ["s"], "ms", MINUTE, end, bound).count() == 0


def test_tail_delta(spark):
    landed = times(spark, [MINUTE * i for i in range(10)])
    latest = incremental.high_water(times(spark, [MINUTE * 4]), ["s"], "ms")
    end = MINUTE * 8

    def got(bound):
        rows_ = incremental.tail_delta(landed, latest, ["s"], "ms", MINUTE, end, F.lit(bound).cast("bigint"))
        return sorted(r.ms // MINUTE for r in rows_.collect())

    assert got(None) == [5, 6, 7, 8]
    assert got(MINUTE * 7) == [7, 8]
    assert got(MINUTE) == [5, 6, 7, 8]
    fresh = incremental.high_water(times(spark, []), ["s"], "ms")
    first = incremental.tail_delta(landed, fresh, ["s"], "ms", MINUTE, end, F.lit(None).cast("bigint"))
    assert first.count() == 10


def test_bounded_bootstrap(spark):
    landed = spark.createDataFrame([("a", 5, 1), ("a", 5, 2), ("a", 1, 1), ("a", 50, 1)], "s string, ms bigint, page int")
    kept = incremental.bounded_bootstrap(landed, ["s", "ms"], "ms", 10, F.lit(2), ["page"])
    assert rows(kept, "ms", "page") == [(5, 2)]


# ---- previous row, sampling, scaling --------------------------------------------------------------


def day_series(spark, n, step_minutes):
    base = ts("2026-01-01 00:00:00")
    made = [("a", base + timedelta(minutes=step_minutes * i), float((i * 7) % 13)) for i in range(n)]
    return spark.createDataFrame(made, "s string, t timestamp, v double"), [v for _, _, v in made]


def test_previous_row_crosses_days_without_rows(spark):
    frame, values = day_series(spark, 40, 700)  # some days hold one row, none is skipped by the carry
    sparse = frame.where("date(t) <> date'2026-01-03'")
    got = [r._1 for r in lagging.with_previous(sparse, ["s"], "t", "v", "_1").orderBy("t").collect()]
    kept = [r.v for r in sparse.orderBy("t").collect()]
    assert got == [None, *kept[:-1]]
    up = [r.is_up for r in lagging.price_direction(frame, ["s"], "t", "v").orderBy("t").collect()]
    assert up == [True, *[b >= a for a, b in zip(values, values[1:], strict=False)]]
    deltas = [r.delta for r in lagging.oi_delta(frame, ["s"], "t", "v").orderBy("t").collect()]
    assert deltas == [0.0, *[b - a for a, b in zip(values, values[1:], strict=False)]]


@pytest.mark.parametrize(("n", "size"), [(50, 100), (1000, 100), (101, 100), (997, 64), (3500, 3000)])
def test_even_sample(spark, n, size):
    frame, _ = day_series(spark, n, 5)
    picked = lagging.even_sample(frame.withColumn("i", F.lit(0)), ["s"], "t", size)
    base = ts("2026-01-01 00:00:00")
    got = sorted(int((r.t - base).total_seconds() // 300) for r in picked.collect())
    if n <= size:
        expected = list(range(n))
    else:
        step = (n - 1) / float(size - 1)
        expected = sorted({round(i * step) for i in range(size)} | {0, n - 1})
    assert got == expected


def test_minmax_scale(spark):
    frame = spark.createDataFrame([("a", 1.0, 5.0), ("a", 3.0, 5.0), ("a", None, 5.0)], "s string, v double, c double")
    got = rows(profile.minmax_scale(frame, ["s"], ["v", "c"]).where("v is not null"), "v_scaled", "c_scaled")
    assert got == [(0.0, 0.0), (1.0, 0.0)]
    assert profile.minmax_scale(frame, ["s"], ["v"]).where("isnan(v_scaled)").count() == 1


def test_histogram_edges(spark):
    frame = spark.createDataFrame([("a", float(i)) for i in range(25)] + [("b", 7.0)] * 3, "s string, v double")
    bins = {(r.s, r.bin): r.rows for r in profile.histogram(frame, ["s"], ["v"]).collect()}
    assert bins[("a", 24)] == 2 and bins[("a", 1)] == 1 and len(bins) == 25
    assert bins[("b", 1)] == 3


def test_descriptive_stats(spark):
    frame = spark.createDataFrame([(1.0,), (3.0,)], "open double")
    got = {r.Variable: tuple(r)[1:] for r in profile.descriptive_stats(frame, ["open", "volume"]).collect()}
    assert got["open"] == (2.0, pytest.approx(2**0.5), 1.0, 3.0)
    assert got["volume"] == (None, None, None, None)


def test_single_row_has_no_deviation(spark):
    frame = spark.createDataFrame([(1.0,)], "open double")
    assert profile.descriptive_stats(frame, ["open"]).first().Std is None


def test_quality_thresholds(spark):
    base = ts("2026-05-01 00:00:00")
    made = [("x", base + timedelta(minutes=i), p, v, s) for i, (p, v, s) in enumerate([(100.0, 10.0, 0.6), (101.0, 11.0, 0.55), (102.0, 12.0, 0.58)])]
    frame = spark.createDataFrame(made, "k string, timestamp_m1 timestamp, price double, volume double, share double")
    checks = quality.quality_thresholds(frame, "timestamp_m1", ["k"], ["price", "volume"], [], "share")
    assert all(r.passed for r in checks.collect()) and checks.count() == 4
    gappy = spark.createDataFrame([("x", base + timedelta(minutes=i), p) for i, p in enumerate([1.0, 1.1, None, 1.2])], "k string, t timestamp, p double")
    got = {r.expectation: (r.value, r.passed) for r in quality.quality_thresholds(gappy, "t", ["k"], [], ["p"]).collect()}
    assert got == {"coverage": (1.0, True), "missing_ratio:p": (0.25, True)}


def test_leakage_guard(spark):
    frame = spark.createDataFrame([(ts("2026-01-01 00:00:00"), ts("2026-01-01 00:01:00"))], "own timestamp, src timestamp")
    with pytest.raises(Exception, match="leakage"):
        quality.no_leakage(frame, "src", "own").collect()
    assert quality.no_leakage(frame, "own", "src").count() == 1


# ---- planning -------------------------------------------------------------------------------------


def test_bounds_precedence(spark):
    entries = spark.createDataFrame(
        [(1, "BTC=2024-01-01"), (2, "deribit:BTC-PERPETUAL=2024-02-01"), (3, " "), (4, "BTC=2024-01-05"), (5, "SOL_USDC=2024-03-01")],
        "position int, entry string",
    )
    bounds = planning.parse_bounds(entries, "entry", "position")
    units = spark.createDataFrame([("deribit", "BTC"), ("other", "BTC"), ("deribit", "SOL"), ("deribit", "ETH")], "exchange string, symbol string")
    got = {(r.exchange, r.symbol): r.start_bound_ms for r in planning.resolve_start_bound(units, bounds, 3000).collect()}
    assert got == {
        ("deribit", "BTC"): ms("2024-02-01"),
        ("other", "BTC"): ms("2024-01-05"),
        ("deribit", "SOL"): ms("2024-03-01"),
        ("deribit", "ETH"): 3000,
    }


@pytest.mark.parametrize("entry", ["BTC", "=2024-01-01", "BTC=", ":BTC=2024-01-01", "BTC=soon"])
def test_bad_bound_entries(spark, entry):
    entries = spark.createDataFrame([(1, entry)], "position int, entry string")
    with pytest.raises(Exception):
        planning.parse_bounds(entries, "entry", "position").collect()


def test_clamp(spark):
    run = date(2026, 5, 16)
    table = spark.createDataFrame([(None,), (ms("2020-01-01"),), (ms("2026-05-10"),)], "b bigint")
    got = [r[0] for r in table.select(planning.clamp_start_bound(F.col("b"), run)).collect()]
    assert got == [ms("2026-04-16"), ms("2026-04-16"), ms("2026-05-10")]


def test_units_and_pending(spark):
    listed = spark.createDataFrame([("BTC", "candles"), ("BTC", "candles"), ("BTC", "perp_trades")], "symbol string, data_group string")
    units = planning.plan_units(listed, ["deribit"], ["spot", "funding", "perp_trades"])
    assert rows(units) == [
        ("deribit", "funding", "BTC", "1m"), ("deribit", "perp_trades", "BTC", "tick"), ("deribit", "spot", "BTC", "1m"),
    ]
    done = units.where("data_type = 'spot'")
    assert planning.pending(units, done, ["exchange", "data_type", "symbol"]).count() == 2
