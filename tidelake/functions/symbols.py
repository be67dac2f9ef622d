"""Symbol, market and option-name columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelake.schemas import DATASET_INSTRUMENT

# ---- fixed values: assets with short names, quote suffixes, endpoint names, option types --------
ASSETS = ["BTC", "ETH", "SOL"]
QUOTE_SUFFIX = "(USDC|USDT|USD)$"
ENDPOINT_NAME = {"SOL-PERPETUAL": "SOL_USDC-PERPETUAL"}
OPTION_TYPE = {"C": "call", "P": "put"}
UNKNOWN = "unknown"


def _strip(c: Column) -> Column:
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def canon_symbol(c: Column) -> Column:
    """Base asset: the first non-empty piece between ``-``, ``_`` and ``/``, in upper case."""
    raw = F.upper(_strip(c))
    piece = F.regexp_extract(raw, "[^-_/]+", 0)
    return F.when(piece == "", raw).otherwise(piece)


def dash_symbol(c: Column) -> Column:
    """Upper case with every separator written as ``-`` (runs of blanks or slashes become one)."""
    return F.replace(F.regexp_replace(F.upper(_strip(c)), r"[\s/]+", "-"), F.lit("_"), F.lit("-"))


def strip_quote_symbol(c: Column) -> Column:
    """Underlying of an instrument name: before ``-PERPETUAL`` or ``_``, else without its quote currency."""
    raw = F.upper(_strip(c))
    return (
        F.when(raw.endswith("-PERPETUAL"), F.substring_index(raw, "-", 1))
        .when(raw.contains("_"), F.substring_index(raw, "_", 1))
        .otherwise(F.regexp_replace(raw, QUOTE_SUFFIX, ""))
    )


def base_asset(c: Column) -> Column:
    return F.substring_index(c, "-", 1)


def storage_symbol(c: Column, market: str, on_unknown: str = "raise") -> Column:
    """Storage name of a symbol or alias: ``BTC`` is ``BTC-PERPETUAL`` (perp) or ``BTC_USDC`` (spot)."""
    if market not in ("spot", "perp"):
        raise ValueError("market must be spot or perp")
    name = F.upper(c)
    tail, passes = ("-PERPETUAL", name.endswith("-PERPETUAL")) if market == "perp" else ("_USDC", name.contains("_"))
    asset = F.regexp_extract(name, f"^({'|'.join(ASSETS)})(USDT|USD)?$", 1)
    bad = F.lit(None).cast("string")
    if on_unknown == "raise":
        bad = F.raise_error(F.concat(F.lit(f"unsupported {market} symbol: "), c)).cast("string")
    return F.when(asset != "", F.concat(asset, F.lit(tail))).when(passes, name).otherwise(bad)


def endpoint_symbol(c: Column) -> Column:
    """Name the funding and open-interest endpoints use for a stored perp symbol."""
    out = c
    for stored, endpoint in ENDPOINT_NAME.items():
        out = F.when(c == stored, F.lit(endpoint)).otherwise(out)
    return out


def clean_symbols(df: DataFrame, column: str = "symbol") -> DataFrame:
    """Trimmed symbols without the null and blank ones."""
    stripped = df.withColumn(column, _strip(F.col(column)))
    return stripped.where(F.col(column).isNotNull() & (F.col(column) != ""))


def dataset_of_market(market: Column, kind: str) -> Column:
    """Dataset type for a market column; ``kind`` is ``ohlcv`` or ``trades``."""
    if kind == "trades":
        return F.when(market == "option", F.lit("option_trades")).otherwise(F.lit("perp_trades"))
    bad = F.raise_error(F.concat(F.lit("unsupported candle market: "), market)).cast("string")
    return F.when(market.isin("spot", "perp"), market).otherwise(bad)


def instrument_of_dataset(dataset: Column) -> Column:
    out = F.lit(None).cast("string")
    for name, instrument in DATASET_INSTRUMENT.items():
        out = F.when(dataset == name, F.lit(instrument)).otherwise(out)
    return out


def option_fields(name: Column) -> Column:
    """``BTC-27DEC24-50000-C`` to a struct (expiry, strike, option_type)."""
    parts = F.split(name, "-")
    whole = F.size(parts) >= 4
    kind = F.upper(F.get(parts, 3))
    label = F.lit(UNKNOWN)
    for code, text in OPTION_TYPE.items():
        label = F.when(whole & (kind == code), F.lit(text)).otherwise(label)
    strike = F.coalesce(F.get(parts, 2).try_cast("double"), F.lit(0.0))
    return F.struct(
        F.when(whole, F.get(parts, 1)).otherwise(F.lit("")).alias("expiry"),
        F.when(whole, strike).otherwise(F.lit(0.0)).alias("strike"),
        label.alias("option_type"),
    )


def trade_side(direction: Column) -> Column:
    side = F.lower(direction)
    return F.when(side.isin("buy", "sell"), side).otherwise(F.lit(UNKNOWN))


def is_maker(marker: Column) -> Column:
    return F.coalesce(F.lower(marker) == "m", F.lit(False))


def float_or_default(c: Column, default: Column | float) -> Column:
    fallback = F.lit(default) if isinstance(default, (int, float)) else default
    return F.coalesce(c.try_cast("double"), fallback)


def price_pick(field: str, prefix: str = "") -> Column:
    """The price column a candle chart shows."""
    # fixed values: selectable fields; "spot" shows the close
    fields = {"spot": "close", "close": "close", "open": "open", "high": "high", "low": "low"}
    if field not in fields:
        raise ValueError(f"unknown price field: {field}")
    return F.col(f"{prefix}{fields[field]}_price")
