"""SQL statements of the feeds and of the steps that several expected results share."""

from __future__ import annotations

_ASSET = "CASE {0} % 3 WHEN 0 THEN 'BTC' WHEN 1 THEN 'ETH' ELSE 'SOL' END"
_NAN, _INF = "'NaN'::DOUBLE", "'Infinity'::DOUBLE"
_FINITE = "isfinite({0})"
MIN1 = "INTERVAL 1 MINUTE"


def _ceil(c: str) -> str:
    return f"CASE WHEN date_trunc('minute', {c}) = {c} THEN {c} ELSE date_trunc('minute', {c}) + {MIN1} END"


def _ticks(dataset: str, instrument: str, symbol: str, endpoint: str, extra: str = "") -> str:
    return f"""
    SELECT 'v1' AS schema_version, '{dataset}' AS dataset_type,
      CASE d WHEN 0 THEN 'DERIBIT' ELSE 'deribit' END AS exchange, {symbol} AS symbol,
      CASE d WHEN 0 THEN '{instrument.upper()}' ELSE '{instrument}' END AS instrument_type, ts AS event_time,
      ts + INTERVAL 1 SECOND + d * INTERVAL 1 HOUR AS ingested_at, 'run-' || d AS run_id, '{endpoint}' AS source_endpoint,
      ts AS open_time, ts AS close_time, 'tick' AS timeframe, CAST(event_id AS VARCHAR) AS trade_id,
      CASE k WHEN 13 THEN NULL WHEN 7 THEN -value WHEN 3 THEN {_NAN} WHEN 4 THEN {_INF} ELSE value END + d AS price,
      CAST(k AS DOUBLE) AS quantity,
      CASE event_type WHEN 'purchase' THEN 'BUY' WHEN 'click' THEN 'sell' ELSE 'unknown' END AS side,
      event_type = 'error' AS is_maker {extra}
    FROM delivered"""


def _minute_candles(market: str) -> str:
    spot = market == "spot"
    t = "date_trunc('minute', ts)" + ("" if spot else f" + {MIN1}")
    v = f"(value * {'1.0' if spot else '1.001'}::DOUBLE)"
    return f"""
    SELECT 'v1' AS schema_version, '{market}' AS dataset_type, 'deribit' AS exchange,
      asset || '{'_USDC' if spot else '-PERPETUAL'}' AS symbol, '{market}' AS instrument_type, {t} AS event_time,
      ts AS ingested_at, 'run-' || event_id AS run_id, 'public_market_data' AS source_endpoint, {t} AS open_time,
      {t} + INTERVAL 59999 MILLISECOND AS close_time, '1m' AS timeframe,
      CASE WHEN k <> 13 THEN {v} END AS open_price, CASE WHEN k = 7 THEN {v} - 5 ELSE {v} + 2 END AS high_price,
      {v} - 1 AS low_price, CASE WHEN k = 3 THEN {_NAN} ELSE {v} + 1 END AS close_price, CAST(k AS DOUBLE) AS volume,
      CAST(NULL AS DOUBLE) AS quote_volume, CAST(0 AS BIGINT) AS trade_count
    FROM ev"""


OHLC_NULL = "(open_price IS NULL OR high_price IS NULL OR low_price IS NULL OR close_price IS NULL)"
OHLC_BAD = (
    "(high_price < greatest(open_price, close_price) OR low_price > least(open_price, close_price) "
    "OR isnan(open_price) OR isnan(high_price) OR isnan(low_price) OR isnan(close_price))"
)
TRADE_BAD = (
    "(trade_time IS NULL OR trade_id IS NULL OR price IS NULL OR NOT isfinite(price) OR price <= 0 "
    "OR quantity IS NULL OR NOT isfinite(quantity) OR quantity <= 0)"
)
OI_BAD = (
    "(timestamp IS NULL OR symbol IS NULL OR length(symbol) = 0 OR open_interest IS NULL "
    "OR NOT isfinite(open_interest) OR open_interest < 0)"
)
FUNDING_NULL = "(funding_rate IS NULL)"
FUNDING_BAD = "(funding_rate IS NOT NULL AND (NOT isfinite(funding_rate) OR abs(funding_rate) > 1))"


def _newest(source: str, key: str, order: str, where: str = "TRUE", columns: str = "*") -> str:
    return f"""
    SELECT {columns} FROM (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY {order}) AS rn_ FROM {source}
      WHERE {where}) WHERE rn_ = 1"""


def _typed(source: str) -> str:
    return f"""
    SELECT * REPLACE (lower(side) AS side, lower(exchange) AS exchange, lower(instrument_type) AS instrument_type),
      open_time AS trade_time FROM {source}"""


def bars_sql(source: str, time: str, unit: str) -> str:
    o = "{'t': trade_time, 'i': trade_id}"
    return f"""
    SELECT *, CASE WHEN volume > 0 THEN buy_volume / volume ELSE 0.0 END AS buy_volume_share FROM (
      SELECT {unit} AS {time}, exchange, symbol, instrument_type, arg_min(price, {o}) AS open_price,
        max(price) AS high_price, min(price) AS low_price, arg_max(price, {o}) AS close_price,
        sum(quantity) AS volume, sum(price * quantity) AS quote_volume, count(*) AS trade_count,
        coalesce(sum(quantity) FILTER (WHERE side = 'buy'), 0.0) AS buy_volume,
        coalesce(sum(quantity) FILTER (WHERE side = 'sell'), 0.0) AS sell_volume,
        count(*) FILTER (WHERE side = 'buy') AS buy_trade_count,
        count(*) FILTER (WHERE side = 'sell') AS sell_trade_count
      FROM {source} GROUP BY 1, 2, 3, 4)"""


def calendar_sql(obs: str, time: str, minute: str, cutoff: str) -> str:
    """Calendar minutes per exchange, symbol and month."""
    return f"""
    SELECT exchange, symbol, month_, unnest(generate_series(month_, last_, {MIN1})) AS {minute} FROM (
      SELECT exchange, symbol, date_trunc('month', {time})::TIMESTAMP AS month_,
        {_ceil(f"least(max({time}), TIMESTAMP '{cutoff}')")} AS last_ FROM {obs} GROUP BY 1, 2, 3) WHERE month_ <= last_"""


def asof_sql(obs: str, time: str, value: str, tie: str, minute: str, cutoff: str) -> str:
    """Calendar minutes with the latest observation of the month at or before them, by an as-of join."""
    return f"""
    SELECT c.{minute}, c.exchange, c.symbol, o.t_ AS {time}, o.v_ AS {value}
    FROM ({calendar_sql(obs, time, minute, cutoff)}) c
    ASOF LEFT JOIN (SELECT exchange, symbol, date_trunc('month', {time})::TIMESTAMP AS month_, {time} AS t_,
        arg_max({value}, {{'a': {tie}, 'b': {value}}}) AS v_ FROM {obs} GROUP BY 1, 2, 3, 4) o
      ON c.exchange = o.exchange AND c.symbol = o.symbol AND c.month_ = o.month_ AND c.{minute} >= o.t_"""


def funding_feature_sql(obs: str, cutoff: str) -> str:
    return f"""
    SELECT timestamp, exchange, symbol, funding_rate AS funding_rate_last_known, funding_time AS funding_observed_at,
      CAST(floor((epoch_us(timestamp) - epoch_us(funding_time)) / 60000000) AS BIGINT) AS minutes_since_funding,
      coalesce(timestamp = funding_time, FALSE) AS is_funding_observation_minute,
      funding_time IS NOT NULL AS funding_data_available
    FROM ({asof_sql(obs, 'funding_time', 'funding_rate', 'ingested_at_max', 'timestamp', cutoff)})"""


def oi_feature_sql(obs: str, cutoff: str) -> str:
    return f"""
    SELECT timestamp_m1, exchange, symbol, open_interest, coalesce(timestamp_m1 = src_, FALSE) AS oi_is_observed,
      coalesce(timestamp_m1 <> src_, TRUE) AS oi_is_ffill,
      CAST(floor((epoch_us(timestamp_m1) - epoch_us(src_)) / 60000000) AS BIGINT) AS minutes_since_oi_observation,
      CAST(floor((epoch_us(timestamp_m1) - epoch_us(src_)) / 1000000) AS BIGINT) AS oi_observation_lag_sec,
      src_ AS oi_source_timestamp
    FROM (SELECT timestamp_m1, exchange, symbol, open_interest, timestamp AS src_ FROM (
      {asof_sql(obs, 'timestamp', 'open_interest', 'ingested_at', 'timestamp_m1', cutoff)}))"""


FAR = "2100-01-01 00:00:00"
_BAR = [
    "open_price", "high_price", "low_price", "close_price", "volume", "quote_volume", "trade_count", "buy_volume",
    "sell_volume", "buy_trade_count", "sell_trade_count", "buy_volume_share",
]


def _renamed(names: list[str], prefix: str) -> str:
    return ", ".join(f"{n} AS {prefix}{n}" for n in names)


def _canon(c: str) -> str:
    raw = f"upper(trim({c}))"
    return f"coalesce(nullif(regexp_extract({raw}, '[^-_/]+'), ''), {raw})"


# name -> (what it reads, statement)
CTES: dict[str, tuple[list[str], str]] = {
    "ev": (
        [],
        f"""SELECT event_id, ts, event_type, value, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
      {_ASSET.format('user_id')} AS asset FROM events""",
    ),
    "delivered": (["ev"], "SELECT *, unnest(CASE WHEN event_type = 'click' THEN [0, 1] ELSE [0] END) AS d FROM ev"),
    "ticks": (["delivered"], _ticks("perp_trades", "perp", "asset || '-PERPETUAL'", "public_trades")),
    "options": (
        ["delivered"],
        _ticks(
            "option_trades",
            "option",
            "asset",
            "public_option_trades",
            """, CASE WHEN k = 7 THEN asset || '-PERPETUAL' ELSE asset || '-' || upper(strftime(ts, '%d%b%y')) || '-' ||
          CASE WHEN k = 13 THEN 'abc' ELSE CAST(k * 1000 AS VARCHAR) END || '-' ||
          CASE WHEN event_type IN ('click', 'purchase') THEN 'C' WHEN event_type = 'view' THEN 'P'
            WHEN event_type = 'signup' THEN 'p' ELSE 'X' END END AS instrument_name""",
        ),
    ),
    "candles": (
        [],
        f"""SELECT 'v1' AS schema_version, market AS dataset_type, 'deribit' AS exchange,
      asset || CASE market WHEN 'spot' THEN '_USDC' ELSE '-PERPETUAL' END AS symbol, market AS instrument_type,
      t AS event_time, t + d * INTERVAL 1 HOUR + INTERVAL 1 MINUTE + l_orderkey * INTERVAL 1 SECOND AS ingested_at,
      'run-' || l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey || '-' || d AS run_id,
      'public_market_data' AS source_endpoint, t AS open_time, t + INTERVAL 59999 MILLISECOND AS close_time,
      '1m' AS timeframe, CASE WHEN l_quantity <> 13 THEN l_extendedprice END AS open_price,
      CASE WHEN l_linenumber = 7 THEN low - 1 ELSE l_extendedprice * (1 + l_tax) END AS high_price, low AS low_price,
      low + d * 0.5::DOUBLE AS close_price, l_quantity AS volume, CAST(NULL AS DOUBLE) AS quote_volume,
      CAST(l_linenumber AS BIGINT) AS trade_count
    FROM (SELECT *, {_ASSET.format('l_suppkey')} AS asset, l_extendedprice * (1 - l_discount) AS low,
      l_shipdate + (l_partkey % 1440) * INTERVAL 1 MINUTE AS t,
      CASE l_linestatus WHEN 'F' THEN 'spot' ELSE 'perp' END AS market,
      unnest(CASE WHEN l_returnflag = 'R' THEN [0, 1] ELSE [0] END) AS d FROM lineitem)""",
    ),
    "spot1": (["ev"], _minute_candles("spot")),
    "perp1": (["ev"], _minute_candles("perp")),
    "funding": (
        ["ev"],
        f"""SELECT 'v1' AS schema_version, 'funding' AS dataset_type, 'deribit' AS exchange,
      asset || '-PERPETUAL' AS symbol, CASE k WHEN 50 THEN 'spot' ELSE 'perp' END AS instrument_type, t AS event_time,
      ts + INTERVAL 1 SECOND + d * INTERVAL 1 HOUR AS ingested_at, 'run-' || event_id AS run_id,
      'public_funding' AS source_endpoint, t AS open_time, t AS close_time, '8h' AS timeframe,
      CASE k WHEN 13 THEN NULL WHEN 7 THEN 1.5 WHEN 3 THEN {_NAN} ELSE value / 1000 + d * 0.25::DOUBLE END AS funding_rate,
      value AS index_price, value + 1 AS mark_price
    FROM (SELECT *, unnest(CASE WHEN k >= 90 THEN [0, 1] ELSE [0] END) AS d,
      CASE WHEN event_type IN ('signup', 'view') THEN date_trunc('minute', ts) ELSE ts END AS t FROM ev)""",
    ),
    "oi": (
        ["ev"],
        f"""SELECT 'v1' AS schema_version, 'oi' AS dataset_type,
      CASE event_type WHEN 'error' THEN ' Deribit ' ELSE 'deribit' END AS exchange,
      CASE WHEN k = 5 THEN '  ' WHEN k = 6 THEN NULL WHEN event_type = 'error' THEN lower(asset) || '_perpetual'
        WHEN event_type = 'signup' THEN ' ' || asset || ' / PERPETUAL ' ELSE asset || '-PERPETUAL' END AS symbol,
      'perp' AS instrument_type, t AS event_time, ts + INTERVAL 1 SECOND + d * INTERVAL 1 HOUR AS ingested_at,
      'run-' || event_id AS run_id, 'public_open_interest' AS source_endpoint, t AS open_time, t AS close_time,
      '1m' AS timeframe,
      CASE k WHEN 13 THEN NULL WHEN 7 THEN -value WHEN 3 THEN {_INF} ELSE value * 100 END AS open_interest,
      0.0::DOUBLE AS open_interest_value
    FROM (SELECT *, unnest(CASE WHEN k >= 90 THEN [0, 1] ELSE [0] END) AS d,
      CASE WHEN event_type IN ('view', 'purchase') THEN date_trunc('minute', ts) ELSE ts END AS t FROM ev)""",
    ),
    "l2": (
        ["ev"],
        """SELECT date_trunc('hour', ts) AS ts_minute, 'deribit' AS exchange, asset AS symbol, count(*) AS snapshot_count,
      count(*) / 10.0::DOUBLE AS coverage_ratio, min(ts) AS first_snapshot_ts, max(ts) AS last_snapshot_ts,
      max(value) - min(value) AS spread FROM ev GROUP BY 1, 2, 3""",
    ),
    # silver steps
    "t_typed": (["ticks"], _typed("ticks")),
    "o_typed": (["options"], _typed("options")),
    "t_obs": (
        ["t_typed"],
        _newest("t_typed", "exchange, instrument_type, symbol, trade_time, trade_id", "ingested_at DESC, run_id DESC", f"NOT {TRADE_BAD}"),
    ),
    "o_obs": (
        ["o_typed"],
        _newest("o_typed", "exchange, instrument_type, symbol, trade_time, trade_id", "ingested_at DESC, run_id DESC", f"NOT {TRADE_BAD}"),
    ),
    "t_bars": (["t_obs"], bars_sql("t_obs", "timestamp_m1", "date_trunc('minute', trade_time)")),
    "o_bars": (["o_obs"], bars_sql("o_obs", "timestamp_m1", "date_trunc('minute', trade_time)")),
    "c_clean": (
        ["candles"],
        _newest(
            "candles",
            "exchange, instrument_type, symbol, timeframe, open_time",
            "ingested_at DESC, run_id DESC",
            f"NOT {OHLC_NULL} AND NOT {OHLC_BAD}",
        ),
    ),
    "spot_s": (
        ["spot1"],
        _newest("spot1", "exchange, symbol, open_time", "ingested_at DESC, run_id DESC", f"NOT {OHLC_NULL} AND NOT {OHLC_BAD}"),
    ),
    "perp_s": (
        ["perp1"],
        _newest("perp1", "exchange, symbol, open_time", "ingested_at DESC, run_id DESC", f"NOT {OHLC_NULL} AND NOT {OHLC_BAD}"),
    ),
    "f_perp": (["funding"], "SELECT *, open_time AS funding_time FROM funding WHERE instrument_type = 'perp'"),
    "f_obs": (
        ["f_perp"],
        f"""SELECT funding_time, exchange, symbol, arg_max(funding_rate, {{'a': ingested_at, 'b': run_id}}) AS funding_rate,
      min(ingested_at) AS ingested_at_min, max(ingested_at) AS ingested_at_max, count(*) AS source_row_count
    FROM f_perp WHERE NOT {FUNDING_NULL} AND NOT {FUNDING_BAD} GROUP BY 1, 2, 3""",
    ),
    "f_feat": (["f_obs"], funding_feature_sql("f_obs", FAR)),
    "oi_typed": (
        ["oi"],
        r"""SELECT * REPLACE (lower(trim(exchange)) AS exchange,
      replace(regexp_replace(upper(trim(symbol)), '[\s/]+', '-', 'g'), '_', '-') AS symbol),
      open_time AS timestamp FROM oi""",
    ),
    "oi_obs": (
        ["oi_typed"],
        _newest("oi_typed", "exchange, symbol, timestamp, open_interest", "ingested_at DESC, run_id DESC", f"NOT {OI_BAD}"),
    ),
    "oi_feat": (["oi_obs"], oi_feature_sql("oi_obs", FAR)),
    # gold inputs
    "g_spot": (
        ["spot_s"],
        f"SELECT open_time AS timestamp_m1, exchange, {_canon('symbol')} AS symbol, {_renamed(_BAR[:5], 'spot_')} FROM spot_s",
    ),
    "g_perp": (
        ["perp_s"],
        f"SELECT open_time AS timestamp_m1, exchange, {_canon('symbol')} AS symbol, {_renamed(_BAR[:5], 'perp_')} FROM perp_s",
    ),
    "g_oi": (
        ["oi_feat"],
        f"""SELECT timestamp_m1, exchange, {_canon('symbol')} AS symbol, open_interest AS oi_open_interest, oi_is_observed,
      oi_is_ffill, minutes_since_oi_observation, oi_observation_lag_sec FROM oi_feat""",
    ),
    "g_funding": (
        ["f_feat"],
        f"""SELECT timestamp AS timestamp_m1, exchange, {_canon('symbol')} AS symbol, funding_rate_last_known,
      minutes_since_funding, is_funding_observation_minute, funding_data_available FROM f_feat""",
    ),
    "g_trades": (
        ["t_bars"],
        f"SELECT timestamp_m1, exchange, {_canon('symbol')} AS symbol, {_renamed(_BAR, 'trades_')} FROM t_bars",
    ),
    "g_options": (
        ["o_bars"],
        f"SELECT timestamp_m1, exchange, {_canon('symbol')} AS symbol, {_renamed(_BAR, 'option_trades_')} FROM o_bars",
    ),
    "g_l2": (
        ["l2"],
        f"""SELECT date_trunc('minute', ts_minute) AS timestamp_m1, exchange, {_canon('symbol')} AS symbol,
      snapshot_count AS l2_snapshot_count, coverage_ratio AS l2_coverage_ratio,
      first_snapshot_ts AS l2_first_snapshot_ts, last_snapshot_ts AS l2_last_snapshot_ts, spread AS l2_spread FROM l2""",
    ),
}


def gold_cte(name: str, inputs: list[str]) -> None:
    """Register the joined table of some inputs on their minute grid as a step."""
    spans = " UNION ALL ".join(
        f"SELECT exchange, symbol, min(timestamp_m1) AS a, max(timestamp_m1) AS z, '{i}' AS i FROM {i} GROUP BY 1, 2"
        for i in inputs
    )
    joins = " ".join(f"LEFT JOIN {i} USING (timestamp_m1, exchange, symbol)" for i in inputs)
    CTES[name] = (
        list(inputs),
        f"""SELECT * FROM (SELECT unnest(generate_series(a, z, {MIN1})) AS timestamp_m1, exchange, symbol FROM (
      SELECT exchange, symbol, min(a) AS a, max(z) AS z FROM ({spans}) GROUP BY 1, 2
      HAVING count(DISTINCT i) = {len(inputs)})) g {joins}""",
    )


def statement(select: str, *names: str) -> str:
    """``select`` with the steps it names, and what those read, in front."""
    order: list[str] = []

    def need(name: str) -> None:
        if name in order:
            return
        for other in CTES[name][0]:
            need(other)
        order.append(name)

    for name in names:
        need(name)
    if not order:
        return select.strip()
    head = ",\n".join(f"{n} AS ({CTES[n][1].strip()})" for n in order)
    return f"WITH {head}\n{select.strip()}"
