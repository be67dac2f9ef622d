"""Validity rules, keep-latest, bars, as-of features and reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidelake.catalog import sql as S
from tidelake.catalog.base import FAR_CUTOFF, query, rounded
from tidelake.functions.times import month_part, trunc_to
from tidelake.operators import asof, dedup, quality
from tidelake.operators.bars import trade_bars
from tidelake.plans import silver
from tidelake.schemas import SILVER_COLUMNS

SERIES = ["exchange", "symbol"]
BAR_SUMS = ("volume", "quote_volume", "buy_volume", "sell_volume", "buy_volume_share")


def _cols(names: list[str]) -> str:
    return ", ".join(names)


def _bar_sql(source: str, time: str, unit: str) -> str:
    sums = ", ".join(f"round({c}, 6) AS {c}" for c in BAR_SUMS)
    return f"SELECT * REPLACE ({sums}) FROM ({S.bars_sql(source, time, unit)})"


# ---- rules and rejects ----------------------------------------------------------------------------


@query(
    "ohlc_null_price",
    f"SELECT dataset_type, symbol, count(*) FILTER (WHERE {S.OHLC_NULL}) AS null_rows, count(*) AS rows FROM candles GROUP BY 1, 2",
    "candles",
)
def ohlc_null_price(f):
    return f.candles().groupBy("dataset_type", "symbol").agg(
        F.count_if(quality.ohlc_null_price()).alias("null_rows"), F.count(F.lit(1)).alias("rows")
    )


@query(
    "ohlc_invalid",
    f"SELECT symbol, open_time, run_id, high_price, low_price FROM candles WHERE NOT {S.OHLC_NULL} AND {S.OHLC_BAD}",
    "candles",
)
def ohlc_invalid(f):
    return f.candles().where(quality.ohlc_invalid()).select("symbol", "open_time", "run_id", "high_price", "low_price")


@query(
    "funding_valid",
    f"""SELECT symbol, funding_time, run_id, ingested_at, funding_rate FROM f_perp
    WHERE NOT {S.FUNDING_NULL} AND NOT {S.FUNDING_BAD}""",
    "f_perp",
)
def funding_valid(f):
    perp = silver.type_funding(f.funding()).where("instrument_type = 'perp'")
    valid = quality.keep_valid(perp, {"null": quality.funding_null(), "invalid": quality.funding_invalid()})
    return valid.select("symbol", "funding_time", "run_id", "ingested_at", "funding_rate")


@query(
    "oi_valid",
    f"SELECT exchange, symbol, timestamp, run_id, ingested_at, open_interest FROM oi_typed WHERE NOT {S.OI_BAD}",
    "oi_typed",
)
def oi_valid(f):
    valid = quality.keep_valid(silver.type_oi(f.oi()), {"invalid": quality.oi_invalid()})
    return valid.select("exchange", "symbol", "timestamp", "run_id", "ingested_at", "open_interest")


@query(
    "trade_valid",
    f"SELECT symbol, trade_time, trade_id, run_id, price, quantity, side FROM t_typed WHERE NOT {S.TRADE_BAD}",
    "t_typed",
)
def trade_valid(f):
    valid = quality.keep_valid(silver.type_trades(f.ticks()), {"invalid": quality.trade_invalid()})
    return valid.select("symbol", "trade_time", "trade_id", "run_id", "price", "quantity", "side")


@query(
    "quality_split",
    f"""SELECT symbol, count(*) AS rows_in, count(*) FILTER (WHERE {S.OHLC_NULL}) AS null_price,
      count(*) FILTER (WHERE NOT {S.OHLC_NULL} AND {S.OHLC_BAD}) AS invalid_ohlc,
      count(*) FILTER (WHERE NOT {S.OHLC_NULL} AND NOT {S.OHLC_BAD}) AS rows_clean FROM candles GROUP BY 1""",
    "candles",
)
def quality_split(f):
    rules = {"null_price": quality.ohlc_null_price(), "invalid_ohlc": quality.ohlc_invalid()}
    return quality.reject_counts(f.candles(), rules, ["symbol"])


@query(
    "type_harmonise",
    """SELECT trade_time, exchange, instrument_type, symbol, trade_id, price, quantity, side, ingested_at FROM t_typed""",
    "t_typed",
)
def type_harmonise(f):
    return silver.type_trades(f.ticks()).select(
        "trade_time", "exchange", "instrument_type", "symbol", "trade_id", "price", "quantity", "side", "ingested_at"
    )


# ---- keep-latest ----------------------------------------------------------------------------------

_CANDLE = [c for c in SILVER_COLUMNS["ohlcv"] if c != "origin_payload"]


@query("ohlcv_clean", f"SELECT {_cols(_CANDLE)} FROM c_clean", "c_clean")
def ohlcv_clean(f):
    return silver.ohlcv_clean(f.candles()).select(*_CANDLE)


@query(
    "dedup_ohlcv",
    "SELECT instrument_type, symbol, open_time, run_id, close_price FROM (" + S._newest(
        "candles", "exchange, instrument_type, symbol, timeframe, open_time", "ingested_at DESC, run_id DESC") + ")",
    "candles",
)
def dedup_ohlcv(f):
    kept = dedup.keep_latest(
        f.candles(), ["exchange", "instrument_type", "symbol", "timeframe", "open_time"], ["ingested_at", "run_id"]
    )
    return kept.select("instrument_type", "symbol", "open_time", "run_id", "close_price")


@query("trades_observed", f"SELECT {_cols(SILVER_COLUMNS['trades_observed'])} FROM t_obs", "t_obs")
def trades_observed(f):
    return silver.trades_observed(f.ticks())


@query(
    "dedup_trades",
    "SELECT symbol, trade_time, trade_id, run_id, price FROM (" + S._newest(
        "t_typed", "exchange, instrument_type, symbol, trade_time, trade_id", "ingested_at DESC, run_id DESC") + ")",
    "t_typed",
)
def dedup_trades(f):
    key = ["exchange", "instrument_type", "symbol", "trade_time", "trade_id"]
    kept = dedup.keep_latest(silver.type_trades(f.ticks()), key, ["ingested_at", "run_id"])
    return kept.select("symbol", "trade_time", "trade_id", "run_id", "price")


@query("option_trades_observed", f"SELECT {_cols(SILVER_COLUMNS['trades_observed'])} FROM o_obs", "o_obs")
def option_trades_observed(f):
    return silver.trades_observed(f.option_ticks())


@query(
    "oi_observed",
    """SELECT timestamp, exchange, symbol, open_interest, timestamp AS oi_source_timestamp, ingested_at, source_endpoint
    FROM oi_obs""",
    "oi_obs",
)
def oi_observed(f):
    return silver.oi_observed(f.oi())


@query(
    "dedup_oi_exact",
    "SELECT exchange, symbol, timestamp, open_interest, run_id, ingested_at FROM (" + S._newest(
        "oi_typed", "exchange, symbol, timestamp, open_interest", "ingested_at DESC, run_id DESC") + ")",
    "oi_typed",
)
def dedup_oi_exact(f):
    # every row without a symbol or value shares a key with its like, so those groups are as large as they get
    key = ["exchange", "symbol", "timestamp", "open_interest"]
    kept = dedup.keep_latest(silver.type_oi(f.oi()), key, ["ingested_at", "run_id"])
    return kept.select(*key, "run_id", "ingested_at")


@query(
    "funding_observed",
    f"""SELECT funding_time, exchange, symbol, split_part(symbol, '-', 1) AS base_asset, 'perp' AS instrument_type,
      funding_rate, CAST(8 AS BIGINT) AS funding_interval_hours, ingested_at_min, ingested_at_max, source_row_count,
      TIMESTAMP '{FAR_CUTOFF}' AS silver_built_at, 'ok' AS data_quality_status FROM f_obs""",
    "f_obs",
)
def funding_observed(f):
    return silver.funding_observed(f.funding(), FAR_CUTOFF)


@query(
    "dedup_funding",
    """SELECT symbol, count(*) AS rows_out, sum(source_row_count)::BIGINT AS rows_clean,
      (sum(source_row_count) - count(*))::BIGINT AS duplicates_removed FROM f_obs GROUP BY 1""",
    "f_obs",
)
def dedup_funding(f):
    observed = silver.funding_observed(f.funding(), FAR_CUTOFF)
    return observed.groupBy("symbol").agg(
        F.count(F.lit(1)).alias("rows_out"),
        F.sum("source_row_count").alias("rows_clean"),
        (F.sum("source_row_count") - F.count(F.lit(1))).alias("duplicates_removed"),
    )


# ---- bars -----------------------------------------------------------------------------------------


@query("trade_bars_1m", _bar_sql("t_obs", "timestamp_m1", "date_trunc('minute', trade_time)"), "t_obs")
def trade_bars_1m(f):
    return rounded(silver.trades_1m_feature(silver.trades_observed(f.ticks())), 6, *BAR_SUMS)


@query("trade_bars_1h", _bar_sql("t_obs", "bar_start", "date_trunc('hour', trade_time)"), "t_obs")
def trade_bars_1h(f):
    return rounded(trade_bars(silver.trades_observed(f.ticks()), 3600, "bar_start"), 6, *BAR_SUMS)


@query("option_bars_1m", _bar_sql("o_obs", "timestamp_m1", "date_trunc('minute', trade_time)"), "o_obs")
def option_bars_1m(f):
    return rounded(silver.trades_1m_feature(silver.trades_observed(f.option_ticks())), 6, *BAR_SUMS)


@query(
    "option_bars_by_instrument",
    f"""SELECT date_trunc('hour', trade_time) AS bar_start, symbol, instrument_name, count(*) AS trade_count,
      round(sum(quantity), 6) AS volume, max(price) AS high_price FROM (
      {S._newest("o_typed", "exchange, instrument_type, symbol, trade_time, trade_id, instrument_name",
                 "ingested_at DESC, run_id DESC", f"NOT {S.TRADE_BAD}")}) GROUP BY 1, 2, 3""",
    "o_typed",
)
def option_bars_by_instrument(f):
    observed = silver.trades_observed(f.option_ticks(), by_instrument=True)
    bars = trade_bars(observed, 3600, "bar_start", ["instrument_name"])
    return rounded(bars, 6, "volume").select(
        "bar_start", "symbol", "instrument_name", "trade_count", "volume", "high_price"
    )


@query(
    "trade_bars_large",
    f"""SELECT * REPLACE (round(volume, 2) AS volume, round(quote_volume, 2) AS quote_volume,
      round(buy_volume, 2) AS buy_volume, round(sell_volume, 2) AS sell_volume, round(buy_volume_share, 6) AS buy_volume_share)
    FROM ({S.bars_sql('item_ticks', 'bar_start', "date_trunc('day', trade_time)")})""",
    "item_ticks",
)
def trade_bars_large(f):
    part = F.pmod("l_suppkey", F.lit(3))
    columns = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice", "l_quantity", "l_returnflag"]
    ticks = f.table("lineitem", *columns).select(
        F.lit("deribit").alias("exchange"),
        F.when(part == 0, "BTC").when(part == 1, "ETH").otherwise("SOL").alias("symbol"),
        F.lit("perp").alias("instrument_type"),
        F.col("l_shipdate").cast("timestamp").alias("trade_time"),
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("trade_id"),
        F.col("l_extendedprice").alias("price"),
        F.col("l_quantity").alias("quantity"),
        F.when(F.col("l_returnflag") == "A", "buy").when(F.col("l_returnflag") == "R", "sell").otherwise("unknown").alias("side"),
    )
    bars = rounded(trade_bars(ticks, 86400, "bar_start"), 2, "volume", "quote_volume", "buy_volume", "sell_volume")
    return rounded(bars, 6, "buy_volume_share")


S.CTES["item_ticks"] = (
    [],
    f"""SELECT 'deribit' AS exchange, {S._ASSET.format('l_suppkey')} AS symbol, 'perp' AS instrument_type,
    l_shipdate AS trade_time, l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey AS trade_id,
    l_extendedprice AS price, l_quantity AS quantity,
    CASE l_returnflag WHEN 'A' THEN 'buy' WHEN 'R' THEN 'sell' ELSE 'unknown' END AS side FROM lineitem""",
)


# ---- calendar and as-of ---------------------------------------------------------------------------

NARROW_CUTOFF = "2024-01-20 12:34:56"


@query("asof_funding_1m", "SELECT * FROM f_feat", "f_feat")
def asof_funding_1m(f):
    return silver.funding_1m_feature(silver.funding_observed(f.funding(), FAR_CUTOFF), FAR_CUTOFF)


@query("asof_funding_1m_cutoff", S.funding_feature_sql("f_obs", NARROW_CUTOFF), "f_obs")
def asof_funding_1m_cutoff(f):
    return silver.funding_1m_feature(silver.funding_observed(f.funding(), FAR_CUTOFF), NARROW_CUTOFF)


@query("asof_oi_1m", "SELECT * FROM oi_feat", "oi_feat")
def asof_oi_1m(f):
    return silver.oi_1m_feature(silver.oi_observed(f.oi()), FAR_CUTOFF)


@query("month_calendar", S.calendar_sql("f_obs", "funding_time", "timestamp_m1", NARROW_CUTOFF).replace("SELECT exchange, symbol, month_, unnest", "SELECT exchange, symbol, unnest", 1), "f_obs")
def month_calendar(f):
    observed = silver.funding_observed(f.funding(), FAR_CUTOFF)
    return asof.month_calendar(observed, SERIES, "funding_time", F.lit(NARROW_CUTOFF).cast("timestamp"))


S.CTES["order_obs"] = (
    [],
    """SELECT 'deribit' AS exchange, o_orderstatus AS symbol, o_totalprice AS open_interest,
      o_orderdate + (o_custkey % 1440) * INTERVAL 1 MINUTE + (o_orderkey % 60) * INTERVAL 1 SECOND AS timestamp,
      o_orderdate + o_orderkey * INTERVAL 1 SECOND AS ingested_at FROM orders""",
)


@query(
    "month_carry_reset",
    f"""SELECT symbol, strftime(timestamp_m1, '%Y-%m') AS month, count(*) AS minutes,
      count(*) FILTER (WHERE open_interest IS NULL) AS empty_minutes,
      sum(oi_observation_lag_sec)::BIGINT AS lag_sec, sum(minutes_since_oi_observation)::BIGINT AS lag_min,
      count(*) FILTER (WHERE oi_is_observed) AS observed, max(oi_source_timestamp) AS last_source
    FROM ({S.oi_feature_sql('order_obs', FAR_CUTOFF)}) GROUP BY 1, 2""",
    "order_obs",
)
def month_carry_reset(f):
    obs = f.table("orders").select(
        F.lit("deribit").alias("exchange"),
        F.col("o_orderstatus").alias("symbol"),
        F.col("o_totalprice").alias("open_interest"),
        F.expr(
            "cast(o_orderdate as timestamp) + make_dt_interval(0, 0, cast(o_custkey % 1440 as int), "
            "cast(o_orderkey % 60 as decimal(18,6)))"
        ).alias("timestamp"),
        F.expr("cast(o_orderdate as timestamp) + make_dt_interval(0, 0, 0, cast(o_orderkey as decimal(18,6)))").alias("ingested_at"),
    )
    filled = silver.oi_1m_feature(obs, FAR_CUTOFF)
    months = filled.groupBy("symbol", F.date_trunc("month", "timestamp_m1").alias("month")).agg(
        F.count(F.lit(1)).alias("minutes"),
        F.count_if(F.col("open_interest").isNull()).alias("empty_minutes"),
        F.sum("oi_observation_lag_sec").alias("lag_sec"),
        F.sum("minutes_since_oi_observation").alias("lag_min"),
        F.count_if("oi_is_observed").alias("observed"),
        F.max("oi_source_timestamp").alias("last_source"),
    )
    return months.withColumn("month", month_part(F.col("month")))


@query(
    "staleness_flags_funding",
    """SELECT symbol, minutes_since_funding, is_funding_observation_minute, funding_data_available, count(*) AS minutes
    FROM f_feat GROUP BY 1, 2, 3, 4""",
    "f_feat",
)
def staleness_flags_funding(f):
    flags = ["symbol", "minutes_since_funding", "is_funding_observation_minute", "funding_data_available"]
    return f.silver("funding_1m_feature").groupBy(*flags).agg(F.count(F.lit(1)).alias("minutes"))


@query(
    "staleness_flags_oi",
    """SELECT symbol, oi_is_observed, oi_is_ffill, minutes_since_oi_observation, count(*) AS minutes,
      sum(oi_observation_lag_sec)::BIGINT AS lag_sec FROM oi_feat GROUP BY 1, 2, 3, 4""",
    "oi_feat",
)
def staleness_flags_oi(f):
    flags = ["symbol", "oi_is_observed", "oi_is_ffill", "minutes_since_oi_observation"]
    return f.silver("oi_1m_feature").groupBy(*flags).agg(
        F.count(F.lit(1)).alias("minutes"), F.sum("oi_observation_lag_sec").alias("lag_sec")
    )


@query(
    "leakage_guard",
    """SELECT exchange, symbol, count(*) AS rows, count(*) FILTER (WHERE oi_source_timestamp > timestamp_m1) AS leaked_rows
    FROM oi_feat GROUP BY 1, 2""",
    "oi_feat",
)
def leakage_guard(f):
    return quality.leakage_count(f.silver("oi_1m_feature"), "oi_source_timestamp", "timestamp_m1", SERIES)


# ---- reports --------------------------------------------------------------------------------------


def _report_sql(dataset: str, source: str, time: str, key: str, null: str, bad: str, scope: str = "TRUE") -> str:
    clean = f"({scope} AND NOT {null} AND NOT {bad})"
    return f"""
    SELECT '{dataset}' AS dataset, exchange, symbol, min(strftime({time}, '%Y-%m')) AS period_start,
      max(strftime({time}, '%Y-%m')) AS period_end,
      string_agg(DISTINCT strftime({time}, '%Y-%m'), ',' ORDER BY strftime({time}, '%Y-%m')) AS months_processed,
      count(*) AS rows_in, count(DISTINCT CASE WHEN {clean} THEN ({key}) END) AS rows_out,
      count(*) FILTER (WHERE {clean}) - count(DISTINCT CASE WHEN {clean} THEN ({key}) END) AS duplicates_removed,
      count(*) FILTER (WHERE {scope} AND {bad}) AS invalid_rows, count(*) FILTER (WHERE {scope} AND {null}) AS null_rows,
      strftime(min({time}) FILTER (WHERE {clean}), '%Y-%m-%dT%H:%M:%SZ') AS min_timestamp,
      strftime(max({time}) FILTER (WHERE {clean}), '%Y-%m-%dT%H:%M:%SZ') AS max_timestamp
    FROM {source} GROUP BY exchange, symbol"""


_C_KEY = "exchange, instrument_type, symbol, timeframe, open_time"


@query(
    "silver_report_ohlcv",
    _report_sql("candles_1m", "candles", "open_time", _C_KEY, S.OHLC_NULL, f"(NOT {S.OHLC_NULL} AND {S.OHLC_BAD})"),
    "candles",
)
def silver_report_ohlcv(f):
    return silver.ohlcv_report(f.candles(), "candles_1m")


@query(
    "silver_report_trades",
    _report_sql(
        "perp_trades_observed", "t_typed", "trade_time", "exchange, instrument_type, symbol, trade_time, trade_id", "FALSE", S.TRADE_BAD
    ),
    "t_typed",
)
def silver_report_trades(f):
    return silver.trades_report(f.ticks(), "perp_trades_observed")


S.CTES["f_all"] = (["funding"], "SELECT *, open_time AS funding_time FROM funding")


@query(
    "silver_report_funding",
    _report_sql(
        "funding_observed", "f_all", "funding_time", "exchange, symbol, funding_time", S.FUNDING_NULL, S.FUNDING_BAD,
        "instrument_type = 'perp'",
    ),
    "f_all",
)
def silver_report_funding(f):
    return silver.funding_report(f.funding())


@query(
    "silver_report_oi",
    _report_sql("oi_observed", "oi_typed", "timestamp", "exchange, symbol, timestamp, open_interest", "FALSE", S.OI_BAD),
    "oi_typed",
)
def silver_report_oi(f):
    return silver.oi_report(f.oi())


@query(
    "quality_thresholds",
    """SELECT exchange, symbol, unnest(['coverage', 'nulls:close_price', 'nulls:volume', 'drift:buy_volume_share']) AS expectation,
      round(unnest([coverage, close_nulls, volume_nulls, drift]), 9) AS value,
      unnest([0.99, 0.0, 0.0, 0.2]::DOUBLE[]) AS limit_value,
      unnest([coverage >= 0.99, close_nulls <= 0, volume_nulls <= 0, drift <= 0.2]) AS passed
    FROM (SELECT exchange, symbol,
      count(*) / (floor((epoch_us(max(timestamp_m1)) - epoch_us(min(timestamp_m1))) / 60000000) + 1)::DOUBLE AS coverage,
      count(*) FILTER (WHERE close_price IS NULL)::DOUBLE AS close_nulls,
      count(*) FILTER (WHERE volume IS NULL)::DOUBLE AS volume_nulls, abs(avg(buy_volume_share) - 0.5) AS drift
      FROM t_bars GROUP BY 1, 2)""",
    "t_bars",
)
def quality_thresholds(f):
    bars = f.silver("perp_trades_1m_feature")
    checks = quality.quality_thresholds(
        bars, "timestamp_m1", SERIES, ["close_price", "volume"], [], share="buy_volume_share"
    )
    return rounded(checks, 9, "value")


@query(
    "trunc_minute",
    """SELECT date_trunc('minute', ts) AS minute, count(*) AS rows,
      count(DISTINCT time_bucket(INTERVAL 15 SECOND, ts)) AS quarter_minutes FROM events GROUP BY 1""",
)
def trunc_minute(f):
    # the quarter minutes are counted from the few distinct values per minute, not from rows
    quarters = (
        f.events()
        .groupBy(trunc_to(F.col("ts"), 60).alias("minute"), trunc_to(F.col("ts"), 15).alias("q"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return quarters.groupBy("minute").agg(F.sum("n").alias("rows"), F.count(F.lit(1)).alias("quarter_minutes"))
