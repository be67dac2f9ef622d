"""Scalar functions applied to whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidelake.catalog import sql as S
from tidelake.catalog.base import query
from tidelake.functions import symbols, times

# loosely written names: every part and customer name turned into an instrument name of some style
S.CTES["names"] = (
    ["ev"],
    """SELECT event_id, CASE event_type WHEN 'click' THEN ' ' || lower(asset) || '_usdc ' WHEN 'view' THEN asset || '/usd'
      WHEN 'error' THEN asset || 'USDT' WHEN 'signup' THEN lower(asset) || '-perpetual' ELSE '-' || k || '  /_x' END AS name, k, value
    FROM ev""",
)


def names(f):
    kind = F.col("event_type")
    name = (
        F.when(kind == "click", F.concat(F.lit(" "), F.lower("asset"), F.lit("_usdc ")))
        .when(kind == "view", F.concat("asset", F.lit("/usd")))
        .when(kind == "error", F.concat("asset", F.lit("USDT")))
        .when(kind == "signup", F.concat(F.lower("asset"), F.lit("-perpetual")))
        .otherwise(F.concat(F.lit("-"), F.col("k").cast("string"), F.lit("  /_x")))
    )
    return f.events().select("event_id", name.alias("name"), "k", "value")


@query("canon_symbol", f"SELECT event_id, {S._canon('name')} AS symbol FROM names", "names")
def canon_symbol(f):
    return names(f).select("event_id", symbols.canon_symbol(F.col("name")).alias("symbol"))


@query(
    "dash_symbol",
    r"SELECT event_id, replace(regexp_replace(upper(trim(name)), '[\s/]+', '-', 'g'), '_', '-') AS symbol FROM names",
    "names",
)
def dash_symbol(f):
    return names(f).select("event_id", symbols.dash_symbol(F.col("name")).alias("symbol"))


@query(
    "strip_quote_symbol",
    """SELECT event_id, CASE WHEN n LIKE '%-PERPETUAL' THEN split_part(n, '-', 1) WHEN contains(n, '_') THEN split_part(n, '_', 1)
      WHEN n LIKE '%USDC' OR n LIKE '%USDT' THEN n[:-5] WHEN n LIKE '%USD' THEN n[:-4] ELSE n END AS symbol
    FROM (SELECT event_id, upper(trim(name)) AS n FROM names)""",
    "names",
)
def strip_quote_symbol(f):
    return names(f).select("event_id", symbols.strip_quote_symbol(F.col("name")).alias("symbol"))


@query(
    "exchange_symbol",
    """SELECT event_id, CASE WHEN n IN ('BTCUSDT', 'ETHUSDT', 'SOLUSDT') THEN n[:3] || '-PERPETUAL' WHEN n LIKE '%-PERPETUAL' THEN n END AS perp,
      CASE WHEN n IN ('BTCUSDT', 'ETHUSDT', 'SOLUSDT') THEN n[:3] || '_USDC' WHEN contains(n, '_') THEN n END AS spot,
      CASE n WHEN 'SOL-PERPETUAL' THEN 'SOL_USDC-PERPETUAL' ELSE n END AS endpoint
    FROM (SELECT event_id, upper(trim(name)) AS n FROM names)""",
    "names",
)
def exchange_symbol(f):
    name = F.trim("name")
    return names(f).select(
        "event_id",
        symbols.storage_symbol(name, "perp", on_unknown="null").alias("perp"),
        symbols.storage_symbol(name, "spot", on_unknown="null").alias("spot"),
        symbols.endpoint_symbol(F.upper(name)).alias("endpoint"),
    )


@query(
    "clean_symbol_list",
    """SELECT event_id, trim(s) AS symbol FROM (SELECT event_id, CASE WHEN k < 5 THEN NULL WHEN k < 10 THEN '   ' ELSE name END AS s FROM names)
    WHERE s IS NOT NULL AND trim(s) <> ''""",
    "names",
)
def clean_symbol_list(f):
    holes = F.when(F.col("k") < 5, F.lit(None)).when(F.col("k") < 10, F.lit("   ")).otherwise(F.col("name"))
    return symbols.clean_symbols(names(f).select("event_id", holes.alias("symbol")))


@query("base_asset", "SELECT event_id, split_part(upper(trim(name)), '-', 1) AS base_asset FROM names", "names")
def base_asset(f):
    return names(f).select("event_id", symbols.base_asset(F.upper(F.trim("name"))).alias("base_asset"))


@query(
    "option_fields",
    """SELECT trade_id, run_id, instrument_name, CASE WHEN len(p) >= 4 THEN p[2] ELSE '' END AS expiry,
      CASE WHEN len(p) >= 4 THEN coalesce(TRY_CAST(p[3] AS DOUBLE), 0) ELSE 0 END AS strike,
      CASE WHEN len(p) < 4 THEN 'unknown' WHEN upper(p[4]) = 'C' THEN 'call' WHEN upper(p[4]) = 'P' THEN 'put' ELSE 'unknown' END AS option_type
    FROM (SELECT *, string_split(instrument_name, '-') AS p FROM options)""",
    "options",
)
def option_fields(f):
    return f.option_ticks().select("trade_id", "run_id", "instrument_name", "expiry", "strike", "option_type")


@query(
    "normalize_side",
    """SELECT event_id, CASE event_type WHEN 'purchase' THEN 'buy' WHEN 'click' THEN 'sell' ELSE 'unknown' END AS side,
      event_type = 'error' AS is_maker FROM ev""",
    "ev",
)
def normalize_side(f):
    kind = F.col("event_type")
    direction = F.when(kind == "purchase", "BUY").when(kind == "click", "Sell").when(kind == "view", "hold")
    return f.events().select(
        "event_id",
        symbols.trade_side(direction).alias("side"),
        symbols.is_maker(F.when(kind == "error", "M").when(kind == "view", "T")).alias("is_maker"),
    )


@query(
    "float_or_default",
    "SELECT event_id, CASE WHEN k < 20 THEN -1.0 ELSE value END AS number, value AS fallback FROM ev",
    "ev",
)
def float_or_default(f):
    text = F.when(F.col("k") < 10, "n/a").when(F.col("k") < 20, F.lit(None)).otherwise(F.col("value").cast("string"))
    return f.events().select(
        "event_id",
        symbols.float_or_default(text, -1.0).alias("number"),
        symbols.float_or_default(text, F.col("value")).alias("fallback"),
    )


@query(
    "lower_keys",
    "SELECT trade_id, run_id, lower(exchange) AS exchange, lower(instrument_type) AS instrument_type, lower(side) AS side FROM ticks",
    "ticks",
)
def lower_keys(f):
    keys = ["exchange", "instrument_type", "side"]
    return f.ticks().select("trade_id", "run_id", *[F.lower(c).alias(c) for c in keys])


@query(
    "minutes_since_lag_seconds",
    """SELECT event_id, CAST(floor(d / 60000000) AS BIGINT) AS minutes_since, CAST(floor(d / 1000000) AS BIGINT) AS lag_seconds
    FROM (SELECT event_id, epoch_us(ts) - epoch_us(date_trunc('day', ts)) AS d FROM ev)""",
    "ev",
)
def minutes_since_lag_seconds(f):
    day = F.date_trunc("day", "ts")
    return f.events().select(
        "event_id",
        times.minutes_between(day, F.col("ts")).alias("minutes_since"),
        times.seconds_between(day, F.col("ts")).alias("lag_seconds"),
    )


@query(
    "time_conversions",
    """SELECT event_id, epoch_us(ts) // 1000 AS ms, make_timestamp(epoch_us(ts) // 1000 * 1000) AS from_ms,
      strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS iso, strftime(ts, '%Y') AS year, strftime(ts, '%Y-%m') AS month,
      strftime(ts, '%Y-%m-%d') AS date FROM ev""",
    "ev",
)
def time_conversions(f):
    ts = F.col("ts")
    return f.events().select(
        "event_id",
        times.ts_to_ms(ts).alias("ms"),
        times.ms_to_ts(times.ts_to_ms(ts)).alias("from_ms"),
        times.iso_utc(ts).alias("iso"),
        times.year_part(ts).alias("year"),
        times.month_part(ts).alias("month"),
        times.date_part(ts).alias("date"),
    )


@query(
    "parse_start_date",
    """SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN epoch_ms(o_orderdate) END AS start_ms FROM orders""",
)
def parse_start_date(f):
    text = F.when(F.col("o_orderstatus") == "P", F.lit("  ")).otherwise(
        F.concat(F.lit(" "), F.date_format("o_orderdate", "yyyy-MM-dd"))
    )
    return f.table("orders").select("o_orderkey", times.parse_start_date(text).alias("start_ms"))


@query(
    "interval_ms",
    """SELECT event_id, CASE WHEN event_type = 'click' THEN 86400000 WHEN event_type = 'view' THEN k * 3600000 ELSE k * 60000 END::BIGINT AS candle_ms,
      CASE WHEN event_type IN ('click', 'view') THEN k * 86400000 ELSE k * 60000 END::BIGINT AS funding_ms FROM ev""",
    "ev",
)
def interval_ms(f):
    kind, k = F.col("event_type"), F.col("k").cast("string")
    candle = F.when(kind == "click", F.lit("1d")).when(kind == "view", F.concat(k, F.lit("h"))).otherwise(F.concat(k, F.lit("m")))
    funding = F.when(kind.isin("click", "view"), F.concat(k, F.lit("d"))).otherwise(F.concat(k, F.lit("m")))
    return f.events().select(
        "event_id", times.interval_ms(candle).alias("candle_ms"), times.period_ms(funding).alias("funding_ms")
    )


@query(
    "timeframe_alias",
    """SELECT event_id, CASE event_type WHEN 'click' THEN k || 'm' WHEN 'view' THEN k || 'M' WHEN 'error' THEN k || 'M'
      WHEN 'signup' THEN k || 'h' ELSE 'x' || k || 'y' END AS timeframe, '1m' AS candle, '8h' AS funding FROM ev""",
    "ev",
)
def timeframe_alias(f):
    kind, k = F.col("event_type"), F.col("k").cast("string")
    written = (
        F.when(kind == "click", F.concat(F.lit("M"), k))
        .when(kind == "view", F.concat(F.lit(" Mn"), k))
        .when(kind == "error", F.concat(k, F.lit("M ")))
        .when(kind == "signup", F.concat(k, F.lit("H")))
        .otherwise(F.concat(F.lit("X"), k, F.lit("Y")))
    )
    candle = F.when(kind == "click", "M1").when(kind == "view", "m1").otherwise("1m")
    funding = F.when(kind == "click", "M1").when(kind == "view", "8H").otherwise("1m")
    return f.events().select(
        "event_id",
        times.timeframe_name(written).alias("timeframe"),
        times.candle_timeframe(candle).alias("candle"),
        times.funding_timeframe(funding).alias("funding"),
    )


@query("price_pick", "SELECT run_id, close_price AS spot, open_price AS open, high_price AS high, low_price AS low FROM candles", "candles")
def price_pick(f):
    return f.candles().select("run_id", *[symbols.price_pick(n).alias(n) for n in ("spot", "open", "high", "low")])


@query(
    "dataset_of_market",
    """SELECT run_id, instrument_type AS dataset_type, CASE instrument_type WHEN 'spot' THEN 'perp_trades' ELSE 'option_trades' END AS trades_dataset,
      CASE instrument_type WHEN 'spot' THEN 'perp' ELSE 'option' END AS trades_instrument FROM candles""",
    "candles",
)
def dataset_of_market(f):
    market = F.col("instrument_type")
    trades = symbols.dataset_of_market(F.when(market == "spot", "perp").otherwise("option"), "trades")
    return f.candles().select(
        "run_id",
        symbols.dataset_of_market(market, "ohlcv").alias("dataset_type"),
        trades.alias("trades_dataset"),
        symbols.instrument_of_dataset(trades).alias("trades_instrument"),
    )
