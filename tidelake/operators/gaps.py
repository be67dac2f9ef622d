"""Missing ranges in time series, in epoch milliseconds."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

DAY_MS = 86_400_000


def interval_buckets(times: DataFrame, series: list[str], ms: str, interval_ms: int) -> DataFrame:
    """First and last time per interval-wide bucket, which is named by its start.

    No gap can start and end inside one bucket, so this map-side reduction keeps gap detection exact while a day of
    ticks shrinks to at most one row per interval.
    """
    return (
        times.where(F.col(ms).isNotNull())
        .groupBy(*series, (F.col(ms) - F.pmod(F.col(ms), F.lit(interval_ms))).alias("_bucket"))
        .agg(F.min(ms).alias("_lo"), F.max(ms).alias("_hi"))
    )


def gap_ranges(times: DataFrame, series: list[str], ms: str, interval_ms: int, end_ms: int) -> DataFrame:
    """Contiguous missing ranges (both ends inclusive) between stored times and from the last one to ``end_ms``.

    Times past ``end_ms`` are ignored and series without times yield nothing. Gaps inside a day come from a window
    per (series, day), gaps across midnight from one row per series and day.
    """
    buckets = interval_buckets(times.where(F.col(ms) <= end_ms), series, ms, interval_ms).withColumn(
        "_day", F.col("_bucket") - F.pmod(F.col("_bucket"), F.lit(DAY_MS))
    )
    days = buckets.groupBy(*series, "_day").agg(F.min("_lo").alias("_lo"), F.max("_hi").alias("_hi"))
    in_day = buckets.select(
        *series, F.lag("_hi").over(Window.partitionBy(*series, "_day").orderBy("_bucket")).alias("_before"), "_lo"
    )
    across = days.select(
        *series, F.lag("_hi").over(Window.partitionBy(*series).orderBy("_day")).alias("_before"), "_lo"
    )
    inner = (
        in_day.unionByName(across)
        .select(*series, (F.col("_before") + interval_ms).alias("start_ms"), (F.col("_lo") - interval_ms).alias("end_ms"))
        .where("start_ms <= end_ms")
    )
    # both ends of a day are used, so that this reads the same shuffled days as the step above
    tail = (
        days.groupBy(*series)
        .agg((F.max(F.greatest("_hi", "_lo")) + interval_ms).alias("start_ms"))
        .withColumn("end_ms", F.lit(end_ms).cast("bigint"))
        .where("start_ms <= end_ms")
    )
    return inner.unionByName(tail)


def head_gap(
    times: DataFrame, series: list[str], ms: str, interval_ms: int, end_ms: int, bound_ms: str | int
) -> DataFrame:
    """The range from a start bound to just before the first stored time; ``bound_ms`` is a column or a constant."""
    bound = F.min(bound_ms) if isinstance(bound_ms, str) else F.lit(bound_ms).cast("bigint")
    first = times.groupBy(*series).agg(F.min(ms).alias("_first"), bound.alias("start_ms"))
    return (
        first.withColumn("end_ms", F.least(F.col("_first") - interval_ms, F.lit(end_ms)))
        .where("start_ms <= end_ms")
        .select(*series, "start_ms", "end_ms")
    )


def split_utc_days(ranges: DataFrame, start: str = "start_ms", end: str = "end_ms") -> DataFrame:
    """Cut inclusive ranges at UTC midnights; a day's slice ends at its last millisecond."""
    keep = [c for c in ranges.columns if c not in (start, end)]
    day = [F.col(c) - F.pmod(F.col(c), F.lit(DAY_MS)) for c in (start, end)]
    return (
        ranges.where(F.col(start) <= F.col(end))
        .withColumn("_day", F.explode(F.sequence(*day, F.lit(DAY_MS))))
        .select(
            *keep,
            F.greatest(F.col(start), F.col("_day")).alias(start),
            F.least(F.col(end), F.col("_day") + (DAY_MS - 1)).alias(end),
        )
    )

