"""Backward as-of fill of sparse observations onto a minute calendar."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelake.functions.times import ceil_minute, minutes_between, month_start, one_minute, seconds_between
from tidelake.session import spread


def calendar_spans(obs: DataFrame, series: list[str], time: str, cutoff: Column | None = None) -> DataFrame:
    """First and last calendar minute per series and month.

    A month's calendar runs from its first minute to the first minute not before the last observation, or to the
    one not before ``cutoff`` when that is earlier. Nothing carries over from the month before.
    """
    last = F.max(time)
    if cutoff is not None:
        last = F.least(last, cutoff)
    return (
        obs.groupBy(*series, month_start(F.col(time)).alias("month_start"))
        .agg(ceil_minute(last).alias("last_minute"))
        .where(F.col("month_start") <= F.col("last_minute"))
    )


def month_calendar(
    obs: DataFrame, series: list[str], time: str, cutoff: Column | None = None, minute: str = "timestamp_m1"
) -> DataFrame:
    """Every calendar minute of every series and month; at most one month of minutes is built per row."""
    spans = calendar_spans(obs, series, time, cutoff).repartition(spread(obs.sparkSession), *series, "month_start")
    return spans.select(*series, F.explode(F.sequence("month_start", "last_minute", one_minute())).alias(minute))


def minute_asof(
    obs: DataFrame,
    series: list[str],
    time: str,
    values: list[str],
    ties: list[str],
    cutoff: Column | None = None,
    minute: str = "timestamp_m1",
) -> DataFrame:
    """Calendar minutes with the latest observation at or before each one (null before a month's first).

    An observation first shows at its own or the next whole minute, so observations are first reduced to the latest
    per such minute (in the map tasks already). The window then sees at most one row per minute of a month, turns
    each into the stretch of minutes it is current for, and the stretch is expanded in place: calendar rows are
    neither shuffled, sorted nor joined. Equal times are settled by ``ties``.
    """
    hit_fields = [time, *ties, *values]
    per_minute = obs.groupBy(
        *series, month_start(F.col(time)).alias("_month"), ceil_minute(F.col(time)).alias("_from")
    ).agg(F.max(F.struct(*dict.fromkeys(hit_fields))).alias("_hit"))
    per_minute = per_minute.repartition(spread(obs.sparkSession), *series, "_month")
    in_month = Window.partitionBy(*series, "_month").orderBy("_from")
    until = F.coalesce(F.lead("_from").over(in_month) - one_minute(), F.col("_from"))
    stretches = per_minute.select(
        *series,
        "_month",
        F.col("_from"),
        until.alias("_until"),
        "_hit",
        F.row_number().over(in_month).alias("_nth"),
    )
    if cutoff is not None:
        stretches = stretches.withColumn("_until", F.least("_until", ceil_minute(cutoff)))
    body = F.struct(F.col("_from").alias("a"), F.col("_until").alias("z"), F.col("_hit").alias("hit"))
    head_end = F.col("_from") - one_minute()
    if cutoff is not None:
        head_end = F.least(head_end, ceil_minute(cutoff))
    no_hit = F.when(F.lit(False), F.col("_hit"))
    head = F.struct(F.col("_month").alias("a"), head_end.alias("z"), no_hit.alias("hit"))
    pieces = F.when(F.col("_nth") == 1, F.array(head, body)).otherwise(F.array(body))
    return (
        stretches.select(*series, F.explode(pieces).alias("_p"))
        .where("_p.a <= _p.z")
        .select(*series, "_p.hit", F.explode(F.sequence("_p.a", "_p.z", one_minute())).alias(minute))
        .select(minute, *series, *[F.col(f"hit.{c}").alias(c) for c in dict.fromkeys([time, *values])])
    )


def funding_flags(df: DataFrame) -> DataFrame:
    now, seen = F.col("timestamp"), F.col("funding_observed_at")
    return df.withColumns(
        {
            "minutes_since_funding": minutes_between(seen, now),
            "is_funding_observation_minute": F.coalesce(now == seen, F.lit(False)),
            "funding_data_available": seen.isNotNull(),
        }
    )


def oi_flags(df: DataFrame) -> DataFrame:
    """Minutes before the first observation count as filled, with a null value."""
    now, seen = F.col("timestamp_m1"), F.col("oi_source_timestamp")
    return df.withColumns(
        {
            "oi_is_observed": F.coalesce(now == seen, F.lit(False)),
            "oi_is_ffill": F.coalesce(now != seen, F.lit(True)),
            "minutes_since_oi_observation": minutes_between(seen, now),
            "oi_observation_lag_sec": seconds_between(seen, now),
        }
    )
