"""Gaps, incremental selection, planning, order-dependent columns and the combined reader's steps."""

from __future__ import annotations

from datetime import date, datetime, timezone

from pyspark.sql import functions as F

from tidelake.catalog import sql as S
from tidelake.catalog.base import query, rounded
from tidelake.functions.times import at, last_closed_open_ms
from tidelake.operators import dedup, gaps, incremental, lagging, planning, profile
from tidelake.plans import combined, silver
from tidelake.schemas import COMBINED_COLUMNS, OHLCV_KEY

MINUTE_MS = 60_000


def _ms(text: str) -> int:
    return int(datetime.fromisoformat(text).replace(tzinfo=timezone.utc).timestamp() * 1000)


END = _ms("2024-01-25 00:00:00")
ETH_BOUND = _ms("2023-12-31 12:00:00")
SOL_BOUND = _ms("2024-01-10 00:00:00")

# What is stored (two kinds of events of two assets, up to a day) and what has landed (all events). SOL has nothing
# stored yet, ETH has a start bound before its first stored time.
_STORED_TYPES = ["click", "view"]
S.CTES["stored"] = (
    ["ev"],
    """SELECT asset AS symbol, epoch_us(ts) // 1000 AS ms FROM ev
    WHERE event_type IN ('click', 'view') AND ts < TIMESTAMP '2024-01-20' AND asset <> 'SOL'""",
)
S.CTES["landed"] = (
    ["ev"],
    f"""SELECT event_id, asset AS symbol, epoch_us(ts) // 1000 AS ms,
      CASE asset WHEN 'ETH' THEN {ETH_BOUND} WHEN 'SOL' THEN {SOL_BOUND} END AS bound FROM ev""",
)


def landed(f):
    symbol = F.col("asset")
    return f.events().select(
        "event_id",
        symbol.alias("symbol"),
        F.unix_millis("ts").alias("ms"),
        F.when(symbol == "ETH", F.lit(ETH_BOUND)).when(symbol == "SOL", F.lit(SOL_BOUND)).alias("bound"),
    )


def stored(f):
    kept = f.events().where(F.col("event_type").isin(_STORED_TYPES) & (F.col("ts") < at("2024-01-20")) & (F.col("asset") != "SOL"))
    return kept.select(F.col("asset").alias("symbol"), F.unix_millis("ts").alias("ms"))


def _gaps_sql(source: str, by: str, interval: int, end: int) -> str:
    key = f"PARTITION BY {by}"
    return f"""
    SELECT {by}, prev + {interval} AS start_ms, ms - {interval} AS end_ms FROM (
      SELECT *, lag(ms) OVER ({key} ORDER BY ms) AS prev FROM (SELECT DISTINCT {by}, ms FROM {source} WHERE ms <= {end}))
    WHERE prev + {interval} <= ms - {interval}
    UNION ALL
    SELECT {by}, max(ms) + {interval}, {end}::BIGINT FROM {source} WHERE ms <= {end} GROUP BY {by}
    HAVING max(ms) + {interval} <= {end}"""


# ---- gaps -----------------------------------------------------------------------------------------

S.CTES["minutes"] = (["ev"], "SELECT asset AS symbol, epoch_ms(date_trunc('minute', ts)) AS ms FROM ev")
S.CTES["candle_ms"] = (["candles"], "SELECT symbol, epoch_ms(open_time) AS ms FROM candles")


def minutes(f):
    return f.events().select(F.col("asset").alias("symbol"), F.unix_millis(F.date_trunc("minute", "ts")).alias("ms"))


@query("gap_ranges", _gaps_sql("minutes", "symbol", MINUTE_MS, END), "minutes")
def gap_ranges(f):
    return gaps.gap_ranges(minutes(f), ["symbol"], "ms", MINUTE_MS, END)


@query("gap_ranges_ticks", _gaps_sql("landed", "symbol", MINUTE_MS, END), "landed")
def gap_ranges_ticks(f):
    return gaps.gap_ranges(landed(f), ["symbol"], "ms", MINUTE_MS, END)


CANDLE_END = _ms("2002-01-01 00:00:00")


@query("gap_ranges_candles", _gaps_sql("candle_ms", "symbol", MINUTE_MS, CANDLE_END), "candle_ms")
def gap_ranges_candles(f):
    times = f.candles().select("symbol", F.unix_millis("open_time").alias("ms"))
    return gaps.gap_ranges(times, ["symbol"], "ms", MINUTE_MS, CANDLE_END)


HEAD = _ms("2023-12-31 23:00:00")


@query(
    "head_gap",
    f"SELECT symbol, {HEAD}::BIGINT AS start_ms, least(min(ms) - {MINUTE_MS}, {END}) AS end_ms FROM minutes GROUP BY 1",
    "minutes",
)
def head_gap(f):
    return gaps.head_gap(minutes(f), ["symbol"], "ms", MINUTE_MS, END, HEAD)


S.CTES["stored_gaps"] = (["stored"], _gaps_sql("stored", "symbol", MINUTE_MS, END))
S.CTES["fill_ranges"] = (
    ["stored_gaps"],
    f"""SELECT * FROM stored_gaps UNION ALL
    SELECT symbol, {ETH_BOUND}, min(ms) - {MINUTE_MS} FROM stored WHERE symbol = 'ETH' GROUP BY 1""",
)


S.CTES["landed_gaps"] = (["landed"], _gaps_sql("landed", "symbol", MINUTE_MS, END))


@query(
    "split_utc_days",
    """SELECT symbol, greatest(start_ms, epoch_ms(day)) AS start_ms, least(end_ms, epoch_ms(day) + 86399999) AS end_ms
    FROM (SELECT *, unnest(generate_series(date_trunc('day', make_timestamp(start_ms * 1000)),
      date_trunc('day', make_timestamp(end_ms * 1000)), INTERVAL 1 DAY)) AS day FROM landed_gaps)""",
    "landed_gaps",
)
def split_utc_days(f):
    return gaps.split_utc_days(gaps.gap_ranges(landed(f), ["symbol"], "ms", MINUTE_MS, END))


@query(
    "last_closed_open",
    "SELECT event_id, (ms // 60000 - 1) * 60000 AS minute_open, (ms // 28800000 - 1) * 28800000 AS funding_open FROM landed",
    "landed",
)
def last_closed_open(f):
    return f.events().select(
        "event_id",
        last_closed_open_ms(MINUTE_MS, F.col("ts")).alias("minute_open"),
        last_closed_open_ms(28_800_000, F.col("ts")).alias("funding_open"),
    )


# ---- incremental ----------------------------------------------------------------------------------


@query(
    "tail_delta",
    f"""SELECT l.event_id, l.symbol, l.ms FROM landed l LEFT JOIN (SELECT symbol, max(ms) AS m FROM stored GROUP BY 1) s USING (symbol)
    WHERE (m IS NULL AND bound IS NULL) OR (l.ms >= greatest(coalesce(m + {MINUTE_MS}, bound), coalesce(bound, m + {MINUTE_MS})) AND l.ms <= {END})""",
    "landed", "stored",
)
def tail_delta(f):
    latest = incremental.high_water(stored(f), ["symbol"], "ms")
    rows = incremental.tail_delta(landed(f), latest, ["symbol"], "ms", MINUTE_MS, END, F.col("bound"))
    return rows.select("event_id", "symbol", "ms")


@query(
    "full_gap_fill",
    f"""SELECT event_id, symbol, ms FROM landed l WHERE EXISTS (SELECT 1 FROM fill_ranges r
      WHERE r.symbol = l.symbol AND l.ms BETWEEN r.start_ms AND r.end_ms)
      OR (symbol = 'SOL' AND ms BETWEEN {SOL_BOUND} AND {END})""",
    "fill_ranges", "landed",
)
def full_gap_fill(f):
    rows = incremental.full_gap_fill(landed(f), stored(f), ["symbol"], "ms", MINUTE_MS, END, F.col("bound"))
    return rows.select("event_id", "symbol", "ms")


@query(
    "bounded_bootstrap",
    "SELECT symbol, ms, event_id FROM (" + S._newest(
        "(SELECT symbol, ms - ms % 60000 AS ms, event_id, bound FROM landed)", "symbol, ms", "event_id DESC",
        f"ms BETWEEN bound AND {END}") + ")",
    "landed",
)
def bounded_bootstrap(f):
    rows = landed(f).withColumn("ms", F.col("ms") - F.col("ms") % MINUTE_MS)
    kept = incremental.bounded_bootstrap(rows, ["symbol", "ms"], "ms", END, F.col("bound"), ["event_id"])
    return kept.select("symbol", "ms", "event_id")


@query("start_bound_filter", "SELECT event_id, symbol, ms FROM landed WHERE bound IS NULL OR ms >= bound", "landed")
def start_bound_filter(f):
    return incremental.start_bound_filter(landed(f), "ms", F.col("bound")).select("event_id", "symbol", "ms")


@query(
    "last_n_candles",
    """SELECT symbol, open_time, close_price FROM (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY open_time DESC) AS rn
      FROM c_clean) WHERE rn <= 100""",
    "c_clean",
)
def last_n_candles(f):
    newest = dedup.keep_last_n(silver.ohlcv_clean(f.candles()), ["symbol"], "open_time", 100)
    return newest.select("symbol", "open_time", "close_price")


@query(
    "dedup_fetched",
    "SELECT symbol, trade_time, trade_id, instrument_name, price FROM (" + S._newest(
        "o_typed", "symbol, trade_time, trade_id, instrument_name", "ingested_at DESC") + ")",
    "o_typed",
)
def dedup_fetched(f):
    typed = silver.type_trades(f.option_ticks())
    key = ["symbol", "trade_time", "trade_id", "instrument_name"]
    return dedup.keep_latest(typed, key, ["ingested_at"]).select(*key, "price")


# ---- planning -------------------------------------------------------------------------------------
# customers stand for configured symbols, their market segments for the group a symbol is configured for

_GROUPS = {"AUTOMOBILE": "candles", "BUILDING": "candles", "FURNITURE": "perp_trades", "MACHINERY": "option_trades"}
_SUFFIX = ["-PERPETUAL", "_USDC", "USDT", "USD", ""]
S.CTES["configured"] = (
    [],
    f"""SELECT 'C' || c_custkey || list_extract({_SUFFIX!r}, (c_nationkey % 5 + 1)::BIGINT) AS symbol,
      CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'candles' WHEN 'BUILDING' THEN 'candles' WHEN 'FURNITURE' THEN 'perp_trades'
        ELSE 'option_trades' END AS data_group, 'C' || c_custkey AS base, c_custkey, c_nationkey, c_acctbal FROM customer""",
)


def configured(f):
    suffix = F.element_at(F.array(*[F.lit(s) for s in _SUFFIX]), F.pmod("c_nationkey", F.lit(5)) + 1)
    base = F.concat(F.lit("C"), F.col("c_custkey").cast("string"))
    group = F.lit("option_trades")
    for segment, name in _GROUPS.items():
        group = F.when(F.col("c_mktsegment") == segment, F.lit(name)).otherwise(group)
    return f.table("customer").select(
        F.concat(base, suffix).alias("symbol"), group.alias("data_group"), base.alias("base"), "c_custkey", "c_nationkey", "c_acctbal"
    )


S.CTES["units"] = (
    ["configured"],
    """SELECT DISTINCT 'deribit' AS exchange, data_type, symbol, CASE WHEN data_type IN ('perp_trades', 'option_trades') THEN 'tick' ELSE '1m' END AS timeframe
    FROM (SELECT symbol, unnest(CASE data_group WHEN 'candles' THEN ['spot', 'perp', 'oi', 'funding']
      WHEN 'perp_trades' THEN ['perp_trades'] ELSE ['option_trades'] END) AS data_type FROM configured)""",
)
_ALL_TYPES = ["spot", "perp", "oi", "funding", "perp_trades", "option_trades"]


def units(f):
    return planning.plan_units(configured(f).select("symbol", "data_group"), ["deribit"], _ALL_TYPES)


@query("plan_units", "SELECT * FROM units", "units")
def plan_units(f):
    return units(f)


@query(
    "pending_partitions",
    """SELECT * FROM units WHERE (data_type, symbol) NOT IN (SELECT 'spot', symbol FROM configured WHERE c_acctbal > 0)""",
    "units", "configured",
)
def pending_partitions(f):
    done = configured(f).where("c_acctbal > 0").select(F.lit("spot").alias("data_type"), "symbol")
    return planning.pending(units(f), done, ["data_type", "symbol"])


_GLOBAL = _ms("2023-01-01 00:00:00")
_ENTRY_TEXT = """CASE WHEN c_nationkey < 8 THEN ' Deribit:' || symbol || '=' ELSE lower(symbol) || '=' END
  || strftime(DATE '2024-01-01' + c_nationkey::INTEGER, '%Y-%m-%d')"""
# An entry for every customer; units find their bounds among those of wealthy customers only, so that some have none.
S.CTES["entries"] = (["configured"], f"SELECT c_custkey AS position, base, c_nationkey, c_acctbal, symbol, {_ENTRY_TEXT} AS entry FROM configured")
_BOUNDS = """SELECT CASE WHEN c_nationkey < 8 THEN 'deribit' END AS exchange, base AS symbol,
      epoch_ms((DATE '2024-01-01' + c_nationkey::INTEGER)::TIMESTAMP) AS start_ms FROM entries"""
S.CTES["all_bounds"] = (["entries"], _BOUNDS)
S.CTES["bounds"] = (["entries"], f"{_BOUNDS} WHERE c_acctbal > 2000")


def entries(f, some: str = "true"):
    day = F.date_format(F.date_add(F.lit("2024-01-01").cast("date"), F.col("c_nationkey")), "yyyy-MM-dd")
    left = F.when(F.col("c_nationkey") < 8, F.concat(F.lit(" Deribit:"), "symbol")).otherwise(F.lower("symbol"))
    rows = configured(f).where(some)
    return rows.select(F.col("c_custkey").alias("position"), F.concat(left, F.lit("="), day).alias("entry"))


@query("parse_bound_entries", "SELECT * FROM all_bounds", "all_bounds")
def parse_bound_entries(f):
    return planning.parse_bounds(entries(f), "entry", "position")


@query(
    "resolve_start_bound",
    f"""SELECT u.*, coalesce(e.start_ms, s.start_ms, {_GLOBAL}) AS start_bound_ms FROM units u
    JOIN (SELECT DISTINCT symbol, base FROM configured) c ON c.symbol = u.symbol
    LEFT JOIN (SELECT * FROM bounds WHERE exchange IS NOT NULL) e ON e.exchange = u.exchange AND e.symbol = c.base
    LEFT JOIN (SELECT * FROM bounds WHERE exchange IS NULL) s ON s.symbol = c.base""",
    "units", "bounds",
)
def resolve_start_bound(f):
    return planning.resolve_start_bound(units(f), planning.parse_bounds(entries(f, "c_acctbal > 2000"), "entry", "position"), _GLOBAL)


RUN_DATE = date(2024, 2, 14)


@query(
    "clamp_start_bound",
    f"""SELECT event_id, greatest(coalesce(bound, m), m) AS bound_ms, greatest(ms, m) AS event_bound_ms
    FROM landed, (SELECT epoch_ms(TIMESTAMP '2024-01-14') AS m)""",
    "landed",
)
def clamp_start_bound(f):
    return landed(f).select(
        "event_id",
        planning.clamp_start_bound(F.col("bound"), RUN_DATE).alias("bound_ms"),
        planning.clamp_start_bound(F.col("ms"), RUN_DATE).alias("event_bound_ms"),
    )


# ---- order-dependent columns ----------------------------------------------------------------------


@query(
    "price_direction",
    """SELECT symbol, open_time, close_price,
      coalesce(close_price >= lag(close_price) OVER (PARTITION BY symbol ORDER BY open_time), TRUE) AS is_up FROM c_clean""",
    "c_clean",
)
def price_direction(f):
    bars = silver.ohlcv_clean(f.candles()).select("symbol", "open_time", "close_price")
    return lagging.price_direction(bars, ["symbol"], "open_time", "close_price")


@query(
    "oi_delta",
    """SELECT symbol, timestamp_m1, open_interest,
      coalesce(open_interest - lag(open_interest) OVER (PARTITION BY symbol ORDER BY timestamp_m1), 0.0) AS delta
    FROM oi_feat WHERE open_interest IS NOT NULL""",
    "oi_feat",
)
def oi_delta(f):
    series = f.silver("oi_1m_feature").where("open_interest is not null").select("symbol", "timestamp_m1", "open_interest")
    return lagging.oi_delta(series, ["symbol"], "timestamp_m1", "open_interest")


# ---- combined reader ------------------------------------------------------------------------------

_COMBINED = [c for c in COMBINED_COLUMNS]
S.CTES["combined"] = (
    ["candles"],
    f"""SELECT {", ".join(f"{c}_price AS {c}" if c in ("open", "high", "low", "close") else c for c in _COMBINED)} FROM candles""",
)


def markets(f):
    both = f.candles()
    return [both.where(f"dataset_type = '{m}'") for m in ("spot", "perp")]


@query(
    "combined_filters",
    """SELECT run_id, symbol, open_time FROM combined WHERE symbol IN ('BTC_USDC', 'ETH-PERPETUAL') AND exchange = 'deribit'
    AND open_time BETWEEN TIMESTAMP '1996-03-01' AND TIMESTAMP '1999-12-31 23:59:59'""",
    "combined",
)
def combined_filters(f):
    kept = combined.combined_filters(
        f.candles(), ["Deribit"], ["btc_usdc", "Eth-Perpetual"], ["1M"], None, "1996-03-01", "1999-12-31 23:59:59"
    )
    return kept.select("run_id", "symbol", "open_time")


@query("rename_ohlc", "SELECT run_id, open, high, low, close FROM combined", "combined")
def rename_ohlc(f):
    return combined.rename_ohlc(f.candles()).select("run_id", "open", "high", "low", "close")


@query("pad_and_order_columns", "SELECT *, NULL::DOUBLE AS spread FROM combined", "combined")
def pad_and_order_columns(f):
    both = combined.combine(markets(f))
    types = {c: dict(both.dtypes)[c] for c in both.columns}
    return dedup.pad_columns(both, {**types, "spread": "double"})


@query(
    "union_relaxed",
    """SELECT instrument_type, symbol, open_time, close_price AS close, NULL::DOUBLE AS open_interest FROM candles
    UNION ALL SELECT instrument_type, symbol, timestamp, NULL, open_interest FROM oi_obs""",
    "candles", "oi_obs",
)
def union_relaxed(f):
    bars = f.candles().select("instrument_type", "symbol", "open_time", F.col("close_price").alias("close"))
    oi = silver.oi_observed(f.oi()).select(
        F.lit("perp").alias("instrument_type"), "symbol", F.col("timestamp").alias("open_time"), "open_interest"
    )
    return dedup.union_relaxed(bars, oi)


@query(
    "sort_combined",
    "SELECT * FROM combined ORDER BY open_time, exchange, instrument_type, symbol, timeframe, run_id LIMIT 1000",
    "combined",
)
def sort_combined(f):
    # ties of the five sort columns are settled by run id, as the SQL side needs the same 1000 rows
    both = combined.combine(markets(f))
    return both.orderBy(*combined.SORT, "run_id").limit(1000)


S.CTES["series_oi"] = (
    ["oi_typed"],
    """SELECT * REPLACE (date_trunc('minute', timestamp) AS open_time) FROM oi_typed WHERE symbol IS NOT NULL""",
)
S.CTES["series_oi_last"] = (
    ["series_oi"],
    S._newest("series_oi", "exchange, instrument_type, symbol, timeframe, open_time", "ingested_at DESC, run_id DESC"),
)


def series_oi(f):
    return silver.type_oi(f.oi()).where("symbol is not null").withColumn("open_time", F.date_trunc("minute", "timestamp"))


@query("dedup_combined_oi", "SELECT symbol, open_time, open_interest, run_id FROM series_oi_last", "series_oi_last")
def dedup_combined_oi(f):
    kept = dedup.keep_latest(series_oi(f), OHLCV_KEY, ["ingested_at", "run_id"])
    return kept.select("symbol", "open_time", "open_interest", "run_id")


@query(
    "combined_oi_join",
    """SELECT c.symbol, c.open_time, c.close_price AS close, o.open_interest, o.open_interest_value
    FROM perp_s c LEFT JOIN series_oi_last o USING (exchange, instrument_type, symbol, timeframe, open_time)""",
    "perp_s", "series_oi_last",
)
def combined_oi_join(f):
    bars = combined.combine([silver.ohlcv_clean(f.minute_candles("perp"))])
    joined = combined.combined_oi_join(bars, series_oi(f))
    return joined.select("symbol", "open_time", "close", "open_interest", "open_interest_value")


@query(
    "descriptive_stats",
    " UNION ALL ".join(
        f"""SELECT '{v}' AS "Variable", round(avg({v}), 6) AS "Mean", round(stddev_samp({v}), 6) AS "Std", min({v}) AS "Min", max({v}) AS "Max"
        FROM combined"""
        for v in combined.STATS_VARIABLES
    ),
    "combined",
)
def descriptive_stats(f):
    both = dedup.union_relaxed(*[combined.rename_ohlc(m) for m in markets(f)])
    return rounded(profile.descriptive_stats(both, combined.STATS_VARIABLES), 6, "Mean", "Std")
