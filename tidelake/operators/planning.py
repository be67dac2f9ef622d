"""Work units, start bounds and what is still to do."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelake.functions.symbols import strip_quote_symbol
from tidelake.functions.times import parse_start_date
from tidelake.operators.dedup import keep_latest

UNIT_TIMEFRAME = "1m"


def plan_units(symbols: DataFrame, exchanges: list[str], data_types: list[str]) -> DataFrame:
    """One unit per exchange, data type and distinct symbol.

    ``symbols`` has ``symbol`` and the group (``data_group``: candles, perp_trades or option_trades) it is listed
    for. Exchanges and data types are short parameter lists, spread by ``explode`` over the symbol rows.
    """
    groups = {
        "candles": [d for d in ("spot", "perp", "oi", "funding") if d in data_types],
        "perp_trades": [d for d in ("perp_trades",) if d in data_types],
        "option_trades": [d for d in ("option_trades",) if d in data_types],
    }
    wanted = F.array().cast("array<string>")
    for group, kinds in groups.items():
        listed = F.array(*[F.lit(k) for k in kinds]).cast("array<string>")
        wanted = F.when(F.col("data_group") == group, listed).otherwise(wanted)
    units = (
        symbols.select("symbol", F.explode(wanted).alias("data_type"))
        .distinct()
        .withColumn("exchange", F.explode(F.array(*[F.lit(e) for e in sorted(set(exchanges))])))
    )
    trades = F.col("data_type").isin("perp_trades", "option_trades")
    return units.select(
        "exchange",
        "data_type",
        "symbol",
        F.when(trades, F.lit("tick")).otherwise(F.lit(UNIT_TIMEFRAME)).alias("timeframe"),
    )


def pending(units: DataFrame, completed: DataFrame, key: list[str]) -> DataFrame:
    """Units without a completed entry."""
    return units.join(completed.select(*key), key, "left_anti")


def bound_entry(entry: Column) -> Column:
    """``SYMBOL=YYYY-MM-DD`` or ``EXCHANGE:SYMBOL=YYYY-MM-DD`` to (exchange, symbol, start_ms).

    ``exchange`` is null for the short form; malformed entries raise.
    """
    text = F.trim(entry)
    left, right = F.substring_index(text, "=", 1), F.substring_index(text, "=", -1)
    has_exchange = left.contains(":")
    exchange = F.lower(F.trim(F.substring_index(left, ":", 1)))
    symbol = strip_quote_symbol(F.when(has_exchange, F.substring_index(left, ":", -1)).otherwise(left))
    start = parse_start_date(right)
    fine = text.contains("=") & (symbol != "") & start.isNotNull() & (~has_exchange | (exchange != ""))
    bad = F.raise_error(F.concat(F.lit("invalid start-date entry: "), text))
    return F.struct(
        F.when(has_exchange, exchange).alias("exchange"),
        F.when(fine, symbol).otherwise(bad.cast("string")).alias("symbol"),
        start.alias("start_ms"),
    )


def parse_bounds(entries: DataFrame, column: str, position: str) -> DataFrame:
    """Bound table from entry texts; blank ones are skipped and the last entry for a key wins."""
    parsed = (
        entries.where(F.trim(column) != "")
        .withColumn("_b", bound_entry(F.col(column)))
        .select(F.col(position).alias("_position"), "_b.*")
    )
    return keep_latest(parsed, ["exchange", "symbol"], ["_position"]).drop("_position")


def resolve_start_bound(units: DataFrame, bounds: DataFrame, global_ms: int | None) -> DataFrame:
    """``start_bound_ms`` per unit: the exchange-and-symbol bound, else the symbol's, else the global one."""
    keyed = units.withColumns({"_ex": F.lower("exchange"), "_sym": strip_quote_symbol(F.col("symbol"))})
    exact = bounds.where("exchange is not null").select(
        F.col("exchange").alias("_ex"), F.col("symbol").alias("_sym"), F.col("start_ms").alias("_exact")
    )
    loose = bounds.where("exchange is null").select(F.col("symbol").alias("_sym"), F.col("start_ms").alias("_loose"))
    found = F.coalesce("_exact", "_loose", F.lit(global_ms).cast("bigint"))
    return (
        keyed.join(exact, ["_ex", "_sym"], "left")
        .join(loose, ["_sym"], "left")
        .select(*units.columns, found.alias("start_bound_ms"))
    )


def clamp_start_bound(bound_ms: Column, run_date: date | Column) -> Column:
    """A bound older than one month before the run, or none at all, becomes that date."""
    day = F.lit(run_date) if isinstance(run_date, date) else run_date
    oldest = F.unix_millis(F.add_months(day, -1).cast("timestamp"))
    return F.greatest(F.coalesce(bound_ms, oldest), oldest)
