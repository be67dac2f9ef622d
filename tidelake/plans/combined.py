"""Combined spot and perp candles with optional open interest, and their descriptive statistics."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelake.functions.times import at
from tidelake.operators.dedup import keep_latest, pad_columns, union_relaxed
from tidelake.operators.profile import descriptive_stats
from tidelake.schemas import COMBINED_COLUMNS, OHLCV_KEY
from tidelake.sources.lake import STORED_ORDER, scan_lake

SORT = ["open_time", "exchange", "instrument_type", "symbol", "timeframe"]
STATS_VARIABLES = ["open", "high", "low", "close", "volume"]
_TYPES = {"open_time": "timestamp", "close_time": "timestamp", "trade_count": "bigint"}
_NUMBERS = {"open", "high", "low", "close", "volume", "quote_volume"}


def combined_filters(
    df: DataFrame,
    exchanges: list[str] | None = None,
    symbols: list[str] | None = None,
    timeframes: list[str] | None = None,
    instrument_types: list[str] | None = None,
    start: datetime | str | None = None,
    end: datetime | str | None = None,
) -> DataFrame:
    """Case-insensitive filters on series columns and an inclusive time range.

    On a lake scan the series filters prune partitions; so do the month and day bounds added for the time range.
    """

    def one_of(column: str, wanted: list[str] | None) -> Column:
        return F.lit(True) if not wanted else F.lower(column).isin([w.lower() for w in wanted])

    out = df.where(
        one_of("exchange", exchanges)
        & one_of("symbol", symbols)
        & one_of("timeframe", timeframes)
        & one_of("instrument_type", instrument_types)
    )
    for moment, above in ((start, True), (end, False)):
        if moment is None:
            continue
        bound = at(moment)
        day = F.date_format(bound, "yyyy-MM-dd")
        out = out.where(F.col("open_time") >= bound if above else F.col("open_time") <= bound)
        if "date" in df.columns:
            out = out.where(F.col("date") >= day if above else F.col("date") <= day)
    return out


def rename_ohlc(df: DataFrame) -> DataFrame:
    """Short price names; a file that has them already keeps its own."""
    short = {}
    for name in ("open", "high", "low", "close"):
        sources = [F.col(c) for c in (name, f"{name}_price") if c in df.columns]
        if sources:
            short[name] = F.coalesce(*sources)
    return df.withColumns(short)


def combine(candles: list[DataFrame], limit: int | None = None) -> DataFrame:
    """Candles of all markets in one column order; with ``limit`` the first rows in sort order, sorted."""
    if limit is not None and limit <= 0:
        raise ValueError("limit must be positive")
    columns = {c: "double" if c in _NUMBERS else _TYPES.get(c, "string") for c in COMBINED_COLUMNS}
    both = pad_columns(union_relaxed(*[rename_ohlc(c) for c in candles]), columns)
    return both if limit is None else both.orderBy(*SORT).limit(limit)


def combined_oi_join(candles: DataFrame, oi: DataFrame | None) -> DataFrame:
    """Add open interest of the same series and time, the latest stored row of each; null without any."""
    names = ["open_interest", "open_interest_value"]
    if oi is None:
        return candles.withColumns({n: F.lit(None).cast("double") for n in names})
    latest = keep_latest(oi, OHLCV_KEY, STORED_ORDER).select(*OHLCV_KEY, *names)
    return candles.join(latest, OHLCV_KEY, "left").select(*candles.columns, *names)


def load_combined(
    spark: SparkSession,
    root: str,
    limit: int | None = None,
    include_open_interest: bool = False,
    **filters: object,
) -> DataFrame:
    """Stored spot and perp candles under :func:`combined_filters`, in sort order, optionally with open interest."""
    out = combine(_candles(spark, root, filters), limit)
    if include_open_interest:
        out = combined_oi_join(out, combined_filters(scan_lake(spark, root, "oi"), **filters))
    # A join keeps no order, so rows are ordered last.
    return out.orderBy(*SORT)


def _candles(spark: SparkSession, root: str, filters: dict) -> list[DataFrame]:
    return [combined_filters(scan_lake(spark, root, market, old_columns=True), **filters) for market in ("spot", "perp")]


def export_stats(spark: SparkSession, root: str, start: datetime, end: datetime, **filters: object) -> DataFrame:
    """Descriptive statistics of stored candles; both ends must name their time zone."""
    if start.tzinfo is None or end.tzinfo is None:
        raise ValueError("start and end need a time zone")
    if start > end:
        raise ValueError("start must not be after end")
    candles = _candles(spark, root, {"start": start, "end": end, **filters})
    return descriptive_stats(combine(candles), STATS_VARIABLES)
