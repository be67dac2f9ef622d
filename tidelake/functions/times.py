"""Time columns: truncation, differences, conversions, interval and timeframe names.

Times are ``timestamp`` columns read in a UTC session.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---- fixed values: interval unit -> milliseconds, accepted timeframes --------------------------
UNIT_MS = {"m": 60_000, "h": 3_600_000, "d": 86_400_000}
CANDLE_TIMEFRAMES = ["1m"]
FUNDING_TIMEFRAME_NAMES = ["1m", "m1", "8h"]
FUNDING_TIMEFRAME = "8h"


def one_minute() -> Column:
    return F.expr("interval 1 minute")


def utc(c: Column) -> Column:
    return c.cast("timestamp")


def trunc_minute(c: Column) -> Column:
    return F.date_trunc("minute", c)


def ceil_minute(c: Column) -> Column:
    """First minute that is not before ``c``."""
    floor = trunc_minute(c)
    return F.when(floor == c, floor).otherwise(floor + one_minute())


def trunc_to(c: Column, seconds: int) -> Column:
    """Start of the bar of ``seconds`` width that holds ``c``."""
    if seconds == 60:
        return trunc_minute(c)
    width = seconds * 1_000_000
    micros = F.unix_micros(c)
    return F.timestamp_micros(micros - F.pmod(micros, F.lit(width)))


def _between(start: Column, end: Column, micros: int) -> Column:
    # plain long arithmetic; calendar differences build date objects per row
    gap = F.unix_micros(end) - F.unix_micros(start)
    return ((gap - gap % micros) / micros).cast("bigint")


def minutes_between(start: Column, end: Column) -> Column:
    """Whole minutes from ``start`` to ``end``, towards zero."""
    return _between(start, end, 60_000_000)


def seconds_between(start: Column, end: Column) -> Column:
    return _between(start, end, 1_000_000)


def ms_to_ts(c: Column) -> Column:
    return F.timestamp_millis(c)


def ts_to_ms(c: Column) -> Column:
    return F.unix_millis(c)


def iso_utc(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def date_part(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM-dd")


def month_part(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM")


def year_part(c: Column) -> Column:
    return F.date_format(c, "yyyy")


def month_start(c: Column) -> Column:
    return F.date_trunc("month", c)


def parse_start_date(c: Column) -> Column:
    """``YYYY-MM-DD`` text to epoch milliseconds; blank text is null, other text an error."""
    text = F.trim(c)
    return F.when(text != "", F.unix_millis(F.to_timestamp(text, "yyyy-MM-dd")))


def interval_ms(c: Column) -> Column:
    """Width of ``5m`` / ``1h`` / ``1d`` in milliseconds; only whole minutes, hours and one day exist for candles."""
    return _width(c, days="^1(d)$")


def period_ms(c: Column) -> Column:
    """Like :func:`interval_ms`, with any number of days (funding periods)."""
    return _width(c, days="^[0-9]+(d)$")


def _width(c: Column, days: str) -> Column:
    count = F.regexp_extract(c, "^([0-9]+)[mhd]$", 1)
    out = F.when(c.rlike("^[0-9]+m$"), count.cast("bigint") * UNIT_MS["m"])
    out = out.when(c.rlike("^[0-9]+h$"), count.cast("bigint") * UNIT_MS["h"])
    out = out.when(c.rlike(days), count.cast("bigint") * UNIT_MS["d"])
    return out.otherwise(F.raise_error(F.concat(F.lit("unsupported interval: "), c)).cast("bigint"))


def timeframe_name(c: Column) -> Column:
    """Canonical spelling of a timeframe: ``M1``, ``1M``, ``Mn1`` and ``1m`` style names to ``<count><unit>``.

    A capital ``M`` after the count means months and keeps its case.
    """
    raw = F.trim(c)
    digits = F.regexp_extract(raw, "([0-9]+)", 1)
    letter = F.regexp_extract(raw, "([A-Za-z])", 1)
    return (
        F.when(F.lower(raw).rlike("^mn[0-9]+$"), F.concat(digits, F.lit("M")))
        .when(raw.rlike("^[A-Za-z][0-9]+$"), F.concat(digits, F.lower(letter)))
        .when(raw.rlike("^[0-9]+M$"), raw)
        .when(raw.rlike("^[0-9]+[A-Za-z]$"), F.concat(digits, F.lower(letter)))
        .otherwise(F.lower(raw))
    )


def candle_timeframe(c: Column) -> Column:
    """:func:`timeframe_name`, raising for names other than the supported ones."""
    name = timeframe_name(c)
    bad = F.raise_error(F.concat(F.lit("unsupported timeframe: "), c)).cast("string")
    return F.when(name.isin(CANDLE_TIMEFRAMES), name).otherwise(bad)


def funding_timeframe(c: Column) -> Column:
    """Funding is stored at its native interval whichever accepted name is given."""
    bad = F.raise_error(F.concat(F.lit("unsupported funding timeframe: "), c)).cast("string")
    return F.when(F.lower(F.trim(c)).isin(FUNDING_TIMEFRAME_NAMES), F.lit(FUNDING_TIMEFRAME)).otherwise(bad)


def last_closed_open_ms(interval: Column | int, now: Column) -> Column:
    """Open time (ms) of the newest interval that has fully closed at ``now``."""
    width = F.lit(interval) if isinstance(interval, int) else interval
    millis = F.unix_millis(now)
    return millis - F.pmod(millis, width) - width


def at(moment: datetime | str) -> Column:
    """A literal instant; naive values are UTC."""
    if isinstance(moment, datetime):
        moment = (moment if moment.tzinfo else moment.replace(tzinfo=timezone.utc)).astimezone(timezone.utc)
        return F.lit(moment.strftime("%Y-%m-%d %H:%M:%S.%f+00:00")).cast("timestamp")
    return F.lit(moment).cast("timestamp")
