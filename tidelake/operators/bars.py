"""Tick to bar aggregation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelake.functions.times import trunc_to
from tidelake.schemas import SILVER_COLUMNS


def trade_bars(
    ticks: DataFrame, seconds: int = 60, time: str = "timestamp_m1", extra_keys: list[str] | None = None
) -> DataFrame:
    """Bars per series and ``seconds``: OHLC, volumes, counts and buy share.

    Ticks with equal time are ordered by trade id. Everything is a mergeable aggregate, so a hot minute is reduced
    in the map tasks before the shuffle.
    """
    keys = [time, "exchange", "symbol", "instrument_type", *(extra_keys or [])]
    price, qty = F.col("price"), F.col("quantity")
    order = F.struct("trade_time", "trade_id")
    buy, sell = F.col("side") == "buy", F.col("side") == "sell"
    bars = (
        ticks.withColumn(time, trunc_to(F.col("trade_time"), seconds))
        .groupBy(*keys)
        .agg(
            F.min_by(price, order).alias("open_price"),
            F.max(price).alias("high_price"),
            F.min(price).alias("low_price"),
            F.max_by(price, order).alias("close_price"),
            F.sum(qty).alias("volume"),
            F.sum(price * qty).alias("quote_volume"),
            F.count(F.lit(1)).alias("trade_count"),
            F.coalesce(F.sum(F.when(buy, qty)), F.lit(0.0)).alias("buy_volume"),
            F.coalesce(F.sum(F.when(sell, qty)), F.lit(0.0)).alias("sell_volume"),
            F.count_if(buy).alias("buy_trade_count"),
            F.count_if(sell).alias("sell_trade_count"),
        )
    )
    share = F.when(F.col("volume") > 0, F.col("buy_volume") / F.col("volume")).otherwise(F.lit(0.0))
    columns = [time, *SILVER_COLUMNS["trades_1m_feature"][1:], *(extra_keys or [])]
    return bars.withColumn("buy_volume_share", share).select(*columns)
