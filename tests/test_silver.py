from __future__ import annotations

import json
import math

import pytest
from conftest import ts
from helpers import bronze, rows

from tidelake.operators.bars import trade_bars
from tidelake.plans import silver
from tidelake.sources import lake


def candle(open_time, ingested, o, h, l, c, **extra):
    return {
        "open_time": open_time, "close_time": open_time, "event_time": open_time, "ingested_at": ingested, "open_price": o,
        "high_price": h, "low_price": l, "close_price": c, "volume": 1.0, "trade_count": 1, "symbol": "BTC_USDC", **extra,
    }


@pytest.fixture
def dirty_candles(spark):
    return bronze(
        spark,
        "spot",
        [
            candle("2026-05-01 00:00:00", "2026-05-01 00:05:00", 100.0, 102.0, 99.0, 101.0),
            candle("2026-05-01 00:00:00", "2026-05-02 00:05:00", 100.0, 102.0, 99.0, 101.6),
            candle("2026-05-01 00:01:00", "2026-05-01 00:05:00", 100.0, 99.0, 98.0, 98.5),
            candle("2026-05-01 00:02:00", "2026-05-01 00:05:00", None, 102.0, 99.0, 101.0),
            candle("2026-05-02 00:00:00", "2026-05-02 00:05:00", 101.0, 103.0, 100.0, 102.0),
        ],
    )


def test_candles_keep_latest_valid(dirty_candles):
    clean = silver.ohlcv_clean(dirty_candles)
    assert rows(clean, "open_time", "close_price") == [
        (ts("2026-05-01 00:00:00"), 101.6),
        (ts("2026-05-02 00:00:00"), 102.0),
    ]


def test_candle_report(dirty_candles):
    r = silver.ohlcv_report(dirty_candles, "spot_1m").first()
    assert (r.rows_in, r.rows_out, r.duplicates_removed, r.invalid_rows, r.null_rows) == (5, 2, 1, 1, 1)
    assert (r.months_processed, r.min_timestamp, r.max_timestamp) == (
        "2026-05", "2026-05-01T00:00:00Z", "2026-05-02T00:00:00Z",
    )


def test_nan_price_is_invalid(spark):
    raw = bronze(spark, "spot", [candle("2026-05-01 00:00:00", "2026-05-01", math.nan, math.nan, 1.0, 2.0)])
    assert silver.ohlcv_clean(raw).count() == 0


def funding(open_time, rate, ingested="2026-05-02", **extra):
    return {
        "open_time": open_time, "close_time": open_time, "ingested_at": ingested, "funding_rate": rate,
        "index_price": 1.0, "mark_price": 1.0, "symbol": "BTC-PERPETUAL", "timeframe": "8h", **extra,
    }


def test_funding_observed_and_feature(spark):
    raw = bronze(
        spark,
        "funding",
        [
            funding("2026-05-01 00:00:00", 0.001),
            funding("2026-05-01 00:00:00", 0.002, "2026-05-03"),
            funding("2026-05-01 08:00:00", 0.003),
            funding("2026-05-01 09:00:00", 1.5),
            funding("2026-05-01 09:00:00", math.nan),
            funding("2026-05-01 10:00:00", None),
            funding("2026-05-01 11:00:00", 0.1, instrument_type="spot"),
        ],
    )
    observed = silver.funding_observed(raw, "2026-06-01")
    assert rows(observed, "funding_time", "funding_rate", "source_row_count", "base_asset") == [
        (ts("2026-05-01 00:00:00"), 0.002, 2, "BTC"),
        (ts("2026-05-01 08:00:00"), 0.003, 1, "BTC"),
    ]
    report = silver.funding_report(raw).first()
    assert (report.rows_in, report.rows_out, report.invalid_rows, report.null_rows) == (7, 2, 2, 1)
    feature = silver.funding_1m_feature(observed, "2026-06-01")
    assert feature.count() == 481
    last = feature.orderBy("timestamp", ascending=False).first()
    assert (last.timestamp, last.minutes_since_funding, last.is_funding_observation_minute) == (ts("2026-05-01 08:00:00"), 0, True)
    before = feature.where("timestamp = timestamp'2026-05-01 07:59:00'").first()
    assert (before.funding_rate_last_known, before.minutes_since_funding) == (0.002, 479)


def oi(open_time, value, **extra):
    return {
        "open_time": open_time, "close_time": open_time, "ingested_at": "2026-05-02", "open_interest": value,
        "open_interest_value": 0.0, "symbol": "btc_perpetual", "exchange": "Deribit", **extra,
    }


def test_oi_observed_and_feature(spark):
    raw = bronze(
        spark,
        "oi",
        [
            oi("2026-05-01 00:00:00", 10.0),
            oi("2026-05-01 00:00:00", 10.0),
            oi("2026-05-01 00:02:00", 12.0),
            oi("2026-05-01 00:01:00", 11.0, symbol=None),
            oi(None, 11.0),
            oi("2026-05-01 00:01:00", -1.0),
        ],
    )
    observed = silver.oi_observed(raw)
    assert rows(observed, "timestamp", "exchange", "symbol", "open_interest") == [
        (ts("2026-05-01 00:00:00"), "deribit", "BTC-PERPETUAL", 10.0),
        (ts("2026-05-01 00:02:00"), "deribit", "BTC-PERPETUAL", 12.0),
    ]
    totals = silver.oi_report(raw).groupBy().sum("rows_in", "rows_out", "duplicates_removed", "invalid_rows").first()
    assert tuple(totals) == (6, 2, 1, 3)
    feature = silver.oi_1m_feature(observed, "2026-06-01")
    assert rows(feature, "timestamp_m1", "open_interest", "oi_is_observed", "oi_is_ffill", "minutes_since_oi_observation") == [
        (ts("2026-05-01 00:00:00"), 10.0, True, False, 0),
        (ts("2026-05-01 00:01:00"), 10.0, False, True, 1),
        (ts("2026-05-01 00:02:00"), 12.0, True, False, 0),
    ]


def test_oi_ties_and_off_minute_observations(spark):
    raw = bronze(
        spark,
        "oi",
        [
            oi("2026-05-01 00:01:30", 10.0, ingested_at="2026-05-02"),
            oi("2026-05-01 00:01:30", 11.0, ingested_at="2026-05-03"),
            oi("2026-05-01 00:01:45", 12.0),
        ],
    )
    feature = silver.oi_1m_feature(silver.oi_observed(raw), "2026-06-01")
    got = rows(feature, "timestamp_m1", "open_interest", "oi_is_observed", "oi_is_ffill", "oi_observation_lag_sec")
    assert got == [
        (ts("2026-05-01 00:00:00"), None, False, True, None),
        (ts("2026-05-01 00:01:00"), None, False, True, None),
        (ts("2026-05-01 00:02:00"), 12.0, False, True, 15),
    ]


def test_asof_restarts_each_month_and_respects_cutoff(spark):
    raw = bronze(spark, "oi", [oi("2026-04-30 23:58:00", 1.0), oi("2026-05-01 00:02:00", 2.0), oi("2026-05-01 00:09:00", 3.0)])
    observed = silver.oi_observed(raw)
    may = silver.oi_1m_feature(observed, "2026-05-01 00:04:10").where("timestamp_m1 >= timestamp'2026-05-01'")
    assert rows(may, "timestamp_m1", "open_interest") == [
        (ts("2026-05-01 00:00:00"), None),
        (ts("2026-05-01 00:01:00"), None),
        (ts("2026-05-01 00:02:00"), 2.0),
        (ts("2026-05-01 00:03:00"), 2.0),
        (ts("2026-05-01 00:04:00"), 2.0),
        (ts("2026-05-01 00:05:00"), 2.0),
    ]
    # a cutoff before the month leaves nothing of it
    assert silver.oi_1m_feature(observed, "2026-03-01").count() == 0


def tick(trade_id, time, price, qty, side, ingested="2026-05-01 00:10:00", **extra):
    return {
        "open_time": time, "close_time": time, "ingested_at": ingested, "trade_id": trade_id, "price": price, "quantity": qty,
        "side": side, "symbol": "BTC-PERPETUAL", "exchange": "DERIBIT", "instrument_type": "PERP", "timeframe": "tick", **extra,
    }


def test_trades_observed(spark):
    raw = bronze(
        spark,
        "perp_trades",
        [
            tick("1", "2026-05-01 00:00:01", 100.0, 1.0, "BUY"),
            tick("1", "2026-05-01 00:00:01", 101.0, 1.0, "BUY", "2026-05-01 00:20:00"),
            tick("2", "2026-05-01 00:00:02", -1.0, 1.0, None),
        ],
    )
    observed = silver.trades_observed(raw)
    assert rows(observed, "trade_id", "price", "exchange", "instrument_type", "side") == [("1", 101.0, "deribit", "perp", "buy")]
    report = silver.trades_report(raw, "perp_trades_observed").first()
    assert (report.rows_in, report.rows_out, report.invalid_rows, report.duplicates_removed) == (3, 1, 1, 1)


def test_bar_of_two_ticks(spark):
    observed = silver.trades_observed(
        bronze(
            spark,
            "perp_trades",
            [
                tick("a", "2026-05-01 00:00:01", 100.0, 2.0, "buy"),
                tick("b", "2026-05-01 00:00:59", 101.0, 1.0, "sell"),
            ],
        )
    )
    bar = trade_bars(observed).first()
    assert (bar.open_price, bar.high_price, bar.low_price, bar.close_price) == (100.0, 101.0, 100.0, 101.0)
    assert (bar.volume, bar.quote_volume, bar.trade_count) == (3.0, 301.0, 2)
    assert (bar.buy_volume, bar.sell_volume, bar.buy_trade_count, bar.sell_trade_count) == (2.0, 1.0, 1, 1)
    assert bar.buy_volume_share == pytest.approx(2 / 3)


def test_bar_without_known_sides(spark):
    observed = silver.trades_observed(
        bronze(spark, "perp_trades", [tick("a", "2026-05-01 00:00:01", 100.0, 2.0, None), tick("b", "2026-05-01 00:00:01", 90.0, 1.0, None)])
    )
    bar = trade_bars(observed).first()
    assert (bar.buy_volume, bar.buy_trade_count, bar.buy_volume_share) == (0.0, 0, 0.0)
    assert (bar.open_price, bar.close_price) == (100.0, 90.0)  # equal times: trade id decides


def test_option_strikes_share_a_bar(spark):
    raw = bronze(
        spark,
        "option_trades",
        [
            tick("1", "2026-05-01 00:00:01", 0.1, 1.0, "buy", symbol="BTC", instrument_name="BTC-27JUN26-1-C"),
            tick("2", "2026-05-01 00:00:02", 0.2, 1.0, "buy", symbol="BTC", instrument_name="BTC-27JUN26-2-C"),
        ],
    )
    assert trade_bars(silver.trades_observed(raw)).count() == 1
    by_contract = silver.trades_observed(raw, by_instrument=True)
    assert trade_bars(by_contract, extra_keys=["instrument_name"]).count() == 2


def test_build_silver_writes_months(spark, dirty_candles, tmp_path):
    bronze_root, silver_root = str(tmp_path / "bronze"), str(tmp_path / "silver")
    lake.upsert_partitions(spark, dirty_candles, bronze_root, "spot")
    report = silver.build_silver(spark, bronze_root, silver_root, "spot", "2026-06-01").first()
    assert report.rows_out == 2
    stored = lake.read_silver(spark, silver_root, "spot", "1m")
    assert rows(stored, "open_time", "close_price", "month") == [
        (ts("2026-05-01 00:00:00"), 101.6, "2026-05"),
        (ts("2026-05-02 00:00:00"), 102.0, "2026-05"),
    ]
    with pytest.raises(ValueError):
        lake.read_silver(spark, silver_root, "perp", "1m")


@pytest.mark.parametrize("dataset", ["perp_trades", "funding", "oi"])
def test_build_silver_features(spark, tmp_path, dataset):
    raw = {
        "perp_trades": lambda: [tick("a", "2026-05-01 00:00:01", 100.0, 2.0, "buy")],
        "funding": lambda: [funding("2026-05-01 00:01:00", 0.1)],
        "oi": lambda: [oi("2026-05-01 00:01:00", 5.0)],
    }[dataset]()
    bronze_root, silver_root = str(tmp_path / "bronze"), str(tmp_path / "silver")
    lake.upsert_partitions(spark, bronze(spark, dataset, raw), bronze_root, dataset)
    silver.build_silver(spark, bronze_root, silver_root, dataset, "2026-06-01", "2026-06-01")
    feature = lake.read_silver(spark, silver_root, f"{dataset}_1m_feature", "1m")
    assert feature.count() == (1 if dataset == "perp_trades" else 2)
    told = spark.read.json(f"{silver_root}/_manifests")
    assert rows(told, "dataset", "month") == [(f"{dataset}_{t}", "2026-05") for t in ("1m_feature", "observed")]
    assert all("exchange" in json.loads(r.feature_metadata) for r in told.collect())
