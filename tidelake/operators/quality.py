"""Validity rules, clean/reject split, and the layer report."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelake.functions.times import iso_utc, month_part
from tidelake.operators.small import join_small


def not_finite(c: Column) -> Column:
    return F.isnan(c) | (F.abs(c) == float("inf"))


def any_of(*rules: Column) -> Column:
    return reduce(lambda a, b: a | b, rules)


# ---- rules ---------------------------------------------------------------------------------------

OHLC = ["open_price", "high_price", "low_price", "close_price"]


def ohlc_null_price() -> Column:
    return any_of(*[F.col(c).isNull() for c in OHLC])


def ohlc_invalid() -> Column:
    """A high below, or a low above, the open or close. False while a price is missing; a NaN price is invalid."""
    o, h, l, c = (F.col(name) for name in OHLC)
    broken = (h < F.greatest(o, c)) | (l > F.least(o, c)) | any_of(*[F.isnan(x) for x in (o, h, l, c)])
    return ~ohlc_null_price() & broken


def funding_null() -> Column:
    return F.col("funding_rate").isNull()


def funding_invalid() -> Column:
    rate = F.col("funding_rate")
    return rate.isNotNull() & (F.isnan(rate) | (F.abs(rate) > 1.0))


def oi_invalid() -> Column:
    oi = F.col("open_interest")
    return (
        F.col("timestamp").isNull()
        | F.col("symbol").isNull()
        | (F.length("symbol") == 0)
        | oi.isNull()
        | not_finite(oi)
        | (oi < 0)
    )


def _not_positive_number(c: Column) -> Column:
    return c.isNull() | not_finite(c) | (c <= 0)


def trade_invalid() -> Column:
    """No time, no id, or a price or quantity that is not a positive number; the side may be anything."""
    return (
        F.col("trade_time").isNull()
        | F.col("trade_id").isNull()
        | _not_positive_number(F.col("price"))
        | _not_positive_number(F.col("quantity"))
    )


# ---- split and report ----------------------------------------------------------------------------


def keep_valid(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    return df.where(~any_of(*rules.values()))


def reject_counts(df: DataFrame, rules: dict[str, Column], by: list[str]) -> DataFrame:
    """Rows, rejects per rule and kept rows for each group, in one pass."""
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("rows_in"),
        *[F.count_if(rule).alias(name) for name, rule in rules.items()],
        F.count_if(~any_of(*rules.values())).alias("rows_clean"),
    )


def silver_report(
    df: DataFrame,
    dataset: str,
    null_rule: Column,
    invalid_rule: Column,
    key: list[str],
    time: str,
    by: list[str],
    in_scope: Column | None = None,
) -> DataFrame:
    """Build report per series: rows in and out, rejects per rule, duplicates, time span and months.

    The first aggregation is on the natural key (wide and even), the second one on the few series, so neither a hot
    series nor a large group of copies meets in one task. ``in_scope`` leaves rows out of everything but ``rows_in``.
    """
    scope = F.lit(True) if in_scope is None else in_scope
    null_row, bad_row = scope & null_rule, scope & invalid_rule
    clean = scope & ~null_rule & ~invalid_rule
    per_key = df.groupBy(*dict.fromkeys([*by, *key])).agg(
        F.count(F.lit(1)).alias("_n"),
        F.count_if(null_row).alias("_null"),
        F.count_if(bad_row).alias("_bad"),
        F.count_if(clean).alias("_clean"),
    )
    kept = F.col("_clean") > 0
    out = per_key.groupBy(*by).agg(
        F.sum("_n").alias("rows_in"),
        F.count_if(kept).alias("rows_out"),
        (F.sum("_clean") - F.count_if(kept)).alias("duplicates_removed"),
        F.sum("_bad").alias("invalid_rows"),
        F.sum("_null").alias("null_rows"),
        iso_utc(F.min(F.when(kept, F.col(time)))).alias("min_timestamp"),
        iso_utc(F.max(F.when(kept, F.col(time)))).alias("max_timestamp"),
        F.array_sort(F.collect_set(month_part(F.col(time)))).alias("months"),
    )
    return out.select(
        F.lit(dataset).alias("dataset"),
        *by,
        F.element_at("months", 1).alias("period_start"),
        F.element_at("months", -1).alias("period_end"),
        F.array_join("months", ",").alias("months_processed"),
        "rows_in",
        "rows_out",
        "duplicates_removed",
        "invalid_rows",
        "null_rows",
        "min_timestamp",
        "max_timestamp",
    )


# ---- order book rows joined into gold ------------------------------------------------------------


def l2_invalid(columns: list[str]) -> Column:
    """Out-of-range coverage, negative count, or first snapshot after the last; rules apply to columns present."""
    have = set(columns)
    if not have & {"l2_coverage_ratio", "l2_snapshot_count"}:
        raise ValueError("no order-book quality column present")
    rules = [F.lit(False)]
    if "l2_coverage_ratio" in have:
        rules += [F.col("l2_coverage_ratio") < 0, F.col("l2_coverage_ratio") > 1]
    if "l2_snapshot_count" in have:
        rules.append(F.col("l2_snapshot_count") < 0)
    if {"l2_first_snapshot_ts", "l2_last_snapshot_ts"} <= have:
        rules.append(F.col("l2_first_snapshot_ts") > F.col("l2_last_snapshot_ts"))
    return any_of(*rules)


def l2_audit(df: DataFrame) -> DataFrame:
    """Bad rows per (exchange, symbol), and the rows a lenient build drops (see :func:`l2_lenient`)."""
    bad = l2_invalid(df.columns)
    counts = df.groupBy("exchange", "symbol").agg(
        F.count(F.lit(1)).alias("_rows"),
        F.count_if(bad).alias("l2_invalid_rows_found"),
        F.count_if(~bad).alias("_good"),
    )
    dropped = F.when(F.col("l2_invalid_rows_found") > 0, F.col("_rows") - F.col("_good")).otherwise(F.lit(0))
    return counts.select("exchange", "symbol", "l2_invalid_rows_found", dropped.alias("l2_invalid_rows_dropped"))


def l2_lenient(df: DataFrame, audit: DataFrame, keep_null_l2: bool = False) -> DataFrame:
    """Drop bad rows.

    For a symbol with at least one bad row, minutes without order-book data go too (their check is null); symbols
    without bad rows keep all. ``keep_null_l2`` keeps those minutes in either case.
    """
    bad = l2_invalid(df.columns)
    if keep_null_l2:
        return df.where(~F.coalesce(bad, F.lit(False)))
    flagged = join_small(df, audit.select("exchange", "symbol", "l2_invalid_rows_found"), ["exchange", "symbol"])
    keep = (F.coalesce("l2_invalid_rows_found", F.lit(0)) == 0) | ~bad
    return flagged.where(keep).select(*df.columns)


def leakage_count(df: DataFrame, source_time: str, own_time: str, by: list[str]) -> DataFrame:
    """Rows per series whose source is newer than the row itself."""
    late = F.col(source_time) > F.col(own_time)
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("rows"), F.count_if(late).alias("leaked_rows"))


def no_leakage(df: DataFrame, source_time: str, own_time: str) -> DataFrame:
    """Pass rows through; a row that would leak the future fails the job."""
    late = F.col(source_time) > F.col(own_time)
    message = F.concat(F.lit("leakage: "), F.col(source_time).cast("string"), F.lit(" > "), F.col(own_time).cast("string"))
    guarded = F.when(late, F.raise_error(message).cast("timestamp")).otherwise(F.col(own_time))
    return df.withColumn(own_time, guarded)


def quality_thresholds(
    df: DataFrame, time: str, by: list[str], required: list[str], bounded: list[str], share: str | None = None
) -> DataFrame:
    """One row per group and expectation with its value, limit and verdict.

    Expectations: minute coverage >= .99, no nulls in ``required``, mean of ``share`` within .2 of .5, and at most
    30 % nulls in each ``bounded`` column.
    """
    rows = F.count(F.lit(1))
    span = F.expr(f"(unix_micros(max({time})) - unix_micros(min({time}))) div 60000000") + 1
    # fixed values: limits
    checks: list[tuple[str, Column, float, str]] = [("coverage", rows / span, 0.99, "min")]
    checks += [(f"nulls:{c}", F.count_if(F.col(c).isNull()).cast("double"), 0.0, "max") for c in required]
    checks += [(f"missing_ratio:{c}", F.count_if(F.col(c).isNull()) / rows, 0.30, "max") for c in bounded]
    if share:
        checks.append((f"drift:{share}", F.abs(F.avg(share) - 0.5), 0.2, "max"))
    wide = df.groupBy(*by).agg(*[value.alias(f"_{i}") for i, (_, value, _, _) in enumerate(checks)])
    cells = []
    for i, (name, _, limit, side) in enumerate(checks):
        value = F.col(f"_{i}")
        passed = value >= limit if side == "min" else value <= limit
        cells.append(
            F.struct(
                F.lit(name).alias("expectation"),
                value.alias("value"),
                F.lit(limit).alias("limit_value"),
                passed.alias("passed"),
            )
        )
    return wide.select(*by, F.inline(F.array(*cells)))
