"""Table contracts: column lists, keys, partition columns and gold dataset specs."""

from __future__ import annotations

from pyspark.sql import types as T

# ---- fixed values: dataset type -> instrument type --------------------------------------------
DATASET_INSTRUMENT = {
    "spot": "spot",
    "perp": "perp",
    "oi": "perp",
    "funding": "perp",
    "perp_trades": "perp",
    "option_trades": "option",
}
BRONZE_DATASETS = list(DATASET_INSTRUMENT)

# ---- fixed values: bronze row constants --------------------------------------------------------
SCHEMA_VERSION = "v1"
SOURCE_ENDPOINT = {
    "spot": "public_market_data",
    "perp": "public_market_data",
    "oi": "public_open_interest",
    "funding": "public_funding",
    "perp_trades": "public_trades",
    "option_trades": "public_option_trades",
}

SERIES = ["exchange", "instrument_type", "symbol", "timeframe"]
GOLD_KEY = ["timestamp_m1", "exchange", "symbol"]

BRONZE_PARTITIONS = ["dataset_type", "exchange", "instrument_type", "symbol", "timeframe", "year", "month", "date"]
BRONZE_PARTITIONS_OLD = [c for c in BRONZE_PARTITIONS if c != "year"]
SILVER_PARTITIONS = ["dataset_type", "exchange", "symbol", "timeframe", "year", "month"]
GOLD_PARTITIONS = ["dataset_id", "feature_set_version", "exchange", "symbol"]


_TYPES = {
    "string": T.StringType(),
    "timestamp": T.TimestampType(),
    "double": T.DoubleType(),
    "bigint": T.LongType(),
    "boolean": T.BooleanType(),
}


def _struct(spec: str, **more: T.DataType) -> T.StructType:
    """``"name type, ..."`` as a schema; made without a session, unlike DDL parsing."""
    fields = [part.split() for part in spec.split(",")]
    plain = [T.StructField(name, _TYPES[kind]) for name, kind in fields]
    return T.StructType([*plain, *[T.StructField(name, kind) for name, kind in more.items()]])


_HEAD = (
    "schema_version string, dataset_type string, exchange string, symbol string, instrument_type string, "
    "event_time timestamp, ingested_at timestamp, run_id string, source_endpoint string, "
    "open_time timestamp, close_time timestamp, timeframe string"
)
_PRICES = "open_price double, high_price double, low_price double, close_price double"
_CANDLE = f"{_PRICES}, volume double, quote_volume double, trade_count bigint"
_TICK = "trade_id string, price double, quantity double, side string, is_maker boolean"
# The payload a candle row was made from, as a struct column.
_ORIGIN = _struct(
    f"exchange string, symbol string, interval string, open_time timestamp, close_time timestamp, {_CANDLE}"
)
_OHLCV = _struct(f"{_HEAD}, {_CANDLE}", origin_payload=_ORIGIN)

BRONZE_SCHEMAS = {
    "spot": _OHLCV,
    "perp": _OHLCV,
    "oi": _struct(f"{_HEAD}, open_interest double, open_interest_value double"),
    "funding": _struct(f"{_HEAD}, funding_rate double, index_price double, mark_price double"),
    "perp_trades": _struct(f"{_HEAD}, {_TICK}"),
    "option_trades": _struct(
        f"{_HEAD}, {_TICK}, instrument_name string, expiry string, strike double, option_type string"
    ),
}
# Short price names that older candle files carry in place of ``*_price``.
OLD_CANDLE_COLUMNS = _struct("open double, high double, low double, close double")

ORIGIN_FIELDS = _ORIGIN.names

# Natural key of a bronze row; the last two exist for trades only.
BRONZE_KEY = [*SERIES, "open_time", "trade_id", "instrument_name"]
OHLCV_KEY = [*SERIES, "open_time"]
TRADE_KEY = ["exchange", "instrument_type", "symbol", "trade_time", "trade_id"]
OI_KEY = ["exchange", "symbol", "timestamp", "open_interest"]
FUNDING_KEY = ["exchange", "symbol", "funding_time"]

# ---- fixed values: silver and gold column orders ----------------------------------------------
SILVER_COLUMNS = {
    "ohlcv": [f.name for f in BRONZE_SCHEMAS["spot"]],
    "funding_observed": [
        "funding_time", "exchange", "symbol", "base_asset", "instrument_type", "funding_rate",
        "funding_interval_hours", "ingested_at_min", "ingested_at_max", "source_row_count",
        "silver_built_at", "data_quality_status",
    ],
    "funding_1m_feature": [
        "timestamp", "exchange", "symbol", "funding_rate_last_known", "funding_observed_at",
        "minutes_since_funding", "is_funding_observation_minute", "funding_data_available",
    ],
    "oi_observed": [
        "timestamp", "exchange", "symbol", "open_interest", "oi_source_timestamp", "ingested_at", "source_endpoint",
    ],
    "oi_1m_feature": [
        "timestamp_m1", "exchange", "symbol", "open_interest", "oi_is_observed", "oi_is_ffill",
        "minutes_since_oi_observation", "oi_observation_lag_sec", "oi_source_timestamp",
    ],
    "trades_observed": [
        "trade_time", "exchange", "symbol", "instrument_type", "trade_id", "price", "quantity", "side",
    ],
    "trades_1m_feature": [
        "timestamp_m1", "exchange", "symbol", "instrument_type", "open_price", "high_price", "low_price",
        "close_price", "volume", "quote_volume", "trade_count", "buy_volume", "sell_volume",
        "buy_trade_count", "sell_trade_count", "buy_volume_share",
    ],
}
_OBSERVED = (
    "trade_time timestamp, exchange string, symbol string, instrument_type string, trade_id string, price double, "
    "quantity double, side string"
)
_BARS = (
    "timestamp_m1 timestamp, exchange string, symbol string, instrument_type string, open_price double, "
    "high_price double, low_price double, close_price double, volume double, quote_volume double, trade_count bigint, "
    "buy_volume double, sell_volume double, buy_trade_count bigint, sell_trade_count bigint, buy_volume_share double"
)
SILVER_SCHEMAS = {
    "spot": _OHLCV,
    "perp": _OHLCV,
    "funding_observed": _struct(
        "funding_time timestamp, exchange string, symbol string, base_asset string, instrument_type string, "
        "funding_rate double, funding_interval_hours bigint, ingested_at_min timestamp, ingested_at_max timestamp, "
        "source_row_count bigint, silver_built_at timestamp, data_quality_status string"
    ),
    "funding_1m_feature": _struct(
        "timestamp timestamp, exchange string, symbol string, funding_rate_last_known double, "
        "funding_observed_at timestamp, minutes_since_funding bigint, is_funding_observation_minute boolean, "
        "funding_data_available boolean"
    ),
    "oi_observed": _struct(
        "timestamp timestamp, exchange string, symbol string, open_interest double, oi_source_timestamp timestamp, "
        "ingested_at timestamp, source_endpoint string"
    ),
    "oi_1m_feature": _struct(
        "timestamp_m1 timestamp, exchange string, symbol string, open_interest double, oi_is_observed boolean, "
        "oi_is_ffill boolean, minutes_since_oi_observation bigint, oi_observation_lag_sec bigint, "
        "oi_source_timestamp timestamp"
    ),
    "perp_trades_observed": _struct(_OBSERVED),
    "option_trades_observed": _struct(_OBSERVED),
    "perp_trades_1m_feature": _struct(_BARS),
    "option_trades_1m_feature": _struct(_BARS),
}
BAR_COLUMNS = SILVER_COLUMNS["trades_1m_feature"][4:]
COMBINED_COLUMNS = [
    "exchange", "instrument_type", "symbol", "timeframe", "open_time", "close_time", "open", "high", "low",
    "close", "volume", "quote_volume", "trade_count", "dataset_type", "run_id", "source_endpoint",
]

# ---- fixed values: gold dataset ids, what each one joins, and its join rule --------------------
_CORE = ["spot", "perp"]
_FULL = ["spot", "perp", "oi_1m_feature", "funding_1m_feature", "perp_trades_1m_feature", "option_trades_1m_feature"]
GOLD_INPUTS = {
    "gold.market.perp_trades.m1": ["perp_trades_1m_feature"],
    "gold.market.option_trades.m1": ["option_trades_1m_feature"],
    "gold.market.core.m1": _CORE,
    "gold.market.core_funding.m1": [*_CORE, "funding_1m_feature"],
    "gold.market.full.m1": _FULL,
    "gold.hybrid.full_l2.m1": _FULL,
}
GOLD_WITH_L2 = {"gold.hybrid.full_l2.m1"}
L2_INPUT = "gold_l2_m1"
JOIN_POLICY = "minute_grid_left_join_coalesce"
JOIN_POLICY_OLD = "full_outer_coalesce"
PROFILE_SAMPLE_ROWS = 3000


def gold_inputs(dataset_id: str) -> list[str]:
    """Silver datasets a gold dataset needs; unknown ids are an error."""
    try:
        return list(GOLD_INPUTS[dataset_id])
    except KeyError:
        raise ValueError(f"unknown gold dataset id: {dataset_id}") from None


def source_key(dataset_type: str) -> str:
    """Name under which a silver dataset is listed in manifests."""
    return f"{dataset_type}_1m" if dataset_type in _CORE else dataset_type
