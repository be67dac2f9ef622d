from __future__ import annotations

import pytest
from conftest import ms, ts
from pyspark.sql import functions as F

from tidelake.functions import symbols, times
from tidelake.schemas import BRONZE_SCHEMAS, GOLD_INPUTS, SILVER_COLUMNS, SILVER_SCHEMAS


def apply(spark, fn, values, kind="string"):
    table = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, c {kind}")
    return [r.v for r in table.select("i", fn(F.col("c")).alias("v")).orderBy("i").collect()]


def test_symbols(spark):
    assert apply(spark, symbols.canon_symbol, ["BTC_USDC", "eth-perpetual", " sol/usd ", "BTCUSDT", "--", ""]) == ["BTC", "ETH", "SOL", "BTCUSDT", "--", ""]
    assert apply(spark, symbols.dash_symbol, [" btc_perpetual", "a / b", "x\t\ty"]) == ["BTC-PERPETUAL", "A-B", "X-Y"]
    assert apply(spark, symbols.strip_quote_symbol, ["btc-perpetual", "ETH_USDC", "SOLUSDT", "ADAUSD", "XRPUSDC", "DOT"]) == ["BTC", "ETH", "SOL", "ADA", "XRP", "DOT"]
    perp = lambda c: symbols.storage_symbol(c, "perp")
    spot = lambda c: symbols.storage_symbol(c, "spot")
    assert apply(spark, perp, ["btc", "ETHUSDT", "XRP-PERPETUAL"]) == ["BTC-PERPETUAL", "ETH-PERPETUAL", "XRP-PERPETUAL"]
    assert apply(spark, spot, ["sol", "BTCUSD", "xrp_usdc"]) == ["SOL_USDC", "BTC_USDC", "XRP_USDC"]
    assert apply(spark, symbols.endpoint_symbol, ["SOL-PERPETUAL", "BTC-PERPETUAL"]) == ["SOL_USDC-PERPETUAL", "BTC-PERPETUAL"]
    for fn in (perp, spot):
        with pytest.raises(Exception, match="unsupported"):
            apply(spark, fn, ["DOGE"])
    with pytest.raises(ValueError):
        symbols.storage_symbol(F.col("c"), "option")


def test_option_names(spark):
    got = apply(spark, symbols.option_fields, ["BTC-27DEC24-50000-C", "BTC-27DEC24-5.5-p", "BTC-27DEC24-x-Q", "BTC-27DEC24", ""])
    assert [tuple(r) for r in got] == [
        ("27DEC24", 50000.0, "call"), ("27DEC24", 5.5, "put"), ("27DEC24", 0.0, "unknown"), ("", 0.0, "unknown"), ("", 0.0, "unknown"),
    ]


def test_markets(spark):
    assert apply(spark, lambda c: symbols.dataset_of_market(c, "trades"), ["option", "perp", "x"]) == ["option_trades", "perp_trades", "perp_trades"]
    with pytest.raises(Exception, match="unsupported"):
        apply(spark, lambda c: symbols.dataset_of_market(c, "ohlcv"), ["option"])
    assert apply(spark, symbols.instrument_of_dataset, ["oi", "option_trades", "x"]) == ["perp", "option", None]
    with pytest.raises(ValueError):
        symbols.price_pick("vwap")


def test_numbers(spark):
    assert apply(spark, lambda c: symbols.float_or_default(c, 1.5), ["2", "x", None]) == [2.0, 1.5, 1.5]


def test_timeframes(spark):
    assert apply(spark, times.timeframe_name, ["M1", "1M", "Mn1", "1m", "H4", "4H", "x"]) == ["1m", "1M", "1M", "1m", "4h", "4h", "x"]
    assert apply(spark, times.candle_timeframe, [" M1 ", "1m"]) == ["1m", "1m"]
    assert apply(spark, times.funding_timeframe, ["1m", "M1", "8H"]) == ["8h", "8h", "8h"]
    assert apply(spark, times.interval_ms, ["5m", "2h", "1d"]) == [300_000, 7_200_000, 86_400_000]
    assert apply(spark, times.period_ms, ["8h", "3d"]) == [28_800_000, 259_200_000]
    for fn, bad in ((times.candle_timeframe, "5m"), (times.funding_timeframe, "1h"), (times.interval_ms, "2d"), (times.period_ms, "1w")):
        with pytest.raises(Exception, match="unsupported"):
            apply(spark, fn, [bad])


def test_dates_and_closing(spark):
    assert apply(spark, times.parse_start_date, ["2024-01-02", " ", None]) == [ms("2024-01-02"), None, None]
    with pytest.raises(Exception):
        apply(spark, times.parse_start_date, ["02.01.2024"])
    closed = lambda c: times.last_closed_open_ms(60_000, c)
    assert apply(spark, closed, [ts("2024-01-01 00:10:30"), ts("2024-01-01 00:10:00")], "timestamp") == [ms("2024-01-01 00:09:00")] * 2
    assert apply(spark, times.ceil_minute, [ts("2024-01-01 00:10:00"), ts("2024-01-01 00:10:00.000001")], "timestamp") == [
        ts("2024-01-01 00:10:00"), ts("2024-01-01 00:11:00"),
    ]
    assert apply(spark, lambda c: times.trunc_to(c, 900), [ts("2024-01-01 00:44:59")], "timestamp") == [ts("2024-01-01 00:30:00")]
    assert apply(spark, times.iso_utc, [ts("2024-01-01 00:10:30.9"), None], "timestamp") == ["2024-01-01T00:10:30Z", None]


def test_contracts():
    assert SILVER_COLUMNS["ohlcv"] == BRONZE_SCHEMAS["spot"].names
    for name in ("funding_observed", "funding_1m_feature", "oi_observed", "oi_1m_feature"):
        assert SILVER_COLUMNS[name] == SILVER_SCHEMAS[name].names
    assert SILVER_COLUMNS["trades_1m_feature"] == SILVER_SCHEMAS["perp_trades_1m_feature"].names
    assert SILVER_COLUMNS["trades_observed"] == SILVER_SCHEMAS["option_trades_observed"].names
    assert len(GOLD_INPUTS) == 6
