"""Previous-row and row-index operators for long series.

A window over a whole series would put a symbol's full history into one task. These work per (series, hour) and carry
the few values that cross the hour through a table with one row per series and hour.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelake.operators.small import join_small, settle

HOUR = "_hour"


def _hour(time: str) -> Column:
    return F.date_trunc("hour", F.col(time))


def with_previous(df: DataFrame, series: list[str], time: str, value: str, out: str) -> DataFrame:
    """Add ``out``: ``value`` of the row before in the series.

    Rows are dealt by (series, hour) once. The last row of each hour is taken from the dealt rows, whole, so that both
    branches need the same columns and the planner runs the exchange, and the input below it, a single time.
    """
    hourly = df.withColumn(HOUR, _hour(time)).repartition(*series, HOUR)
    in_hour = Window.partitionBy(*series, HOUR).orderBy(time)
    rows = hourly.withColumns({"_lag": F.lag(value).over(in_hour), "_nth": F.row_number().over(in_hour)})
    last = hourly.groupBy(*series, HOUR).agg(F.max_by(F.struct(*df.columns), time)[value].alias("_last"))
    before = last.select(*series, HOUR, F.lag("_last").over(Window.partitionBy(*series).orderBy(HOUR)).alias("_carry"))
    return (
        rows.join(before, [*series, HOUR], "left")
        .withColumn(out, F.when(F.col("_nth") == 1, F.col("_carry")).otherwise(F.col("_lag")))
        .select(*df.columns, out)
    )


def with_row_index(df: DataFrame, series: list[str], time: str, index: str, total: str) -> DataFrame:
    """Add the zero-based position of each row in its series, by time, and the series length.

    The input is written once: it is a join as a rule, which would run for both the rows and the offsets.
    """
    hourly = settle(df, "series").withColumn(HOUR, _hour(time))
    in_hour = Window.partitionBy(*series, HOUR).orderBy(time)
    counts = hourly.groupBy(*series, HOUR).agg(F.count(F.lit(1)).alias("_n"))
    by_series = Window.partitionBy(*series)
    before = by_series.orderBy(HOUR).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        *series,
        HOUR,
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"),
        F.sum("_n").over(by_series).alias(total),
    )
    return (
        join_small(hourly.withColumn("_nth", F.row_number().over(in_hour)), offsets, [*series, HOUR], "inner")
        .withColumn(index, F.col("_offset") + F.col("_nth") - 1)
        .select(*df.columns, index, total)
    )


def price_direction(df: DataFrame, series: list[str], time: str, price: str) -> DataFrame:
    """``is_up``: price not below the bar before; a first bar is up."""
    rows = with_previous(df, series, time, price, "_previous")
    up = F.coalesce(F.col(price) >= F.col("_previous"), F.lit(True))
    return rows.withColumn("is_up", up).drop("_previous")


def oi_delta(df: DataFrame, series: list[str], time: str, value: str) -> DataFrame:
    """``delta``: change against the row before; zero for the first."""
    rows = with_previous(df, series, time, value, "_previous")
    return rows.withColumn("delta", F.coalesce(F.col(value) - F.col("_previous"), F.lit(0.0))).drop("_previous")


def even_sample(df: DataFrame, series: list[str], time: str, size: int) -> DataFrame:
    """At most ``size`` evenly spaced rows per series, both ends included.

    Row ``i`` is kept when it equals ``round(j * step)`` (half to even) for some ``j``; as steps are wider than one
    row, only the two ``j`` around ``i / step`` can match, so no join with a list of positions is needed.
    """
    rows = with_row_index(df, series, time, "_i", "_n")
    step = (F.col("_n") - 1) / F.lit(float(size - 1))
    near = F.floor(F.col("_i") / step)
    chosen = [
        (near + k >= 0) & (near + k <= size - 1) & (F.rint((near + k).cast("double") * step) == F.col("_i"))
        for k in (-1, 0, 1)
    ]
    ends = (F.col("_i") == 0) | (F.col("_i") == F.col("_n") - 1)
    keep = (F.col("_n") <= size) | ends | chosen[0] | chosen[1] | chosen[2]
    return rows.where(keep).drop("_i", "_n")
