"""Which landed rows a stored table still needs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelake.operators.dedup import keep_latest
from tidelake.operators.gaps import interval_buckets
from tidelake.operators.small import join_small


def high_water(stored: DataFrame, series: list[str], ms: str) -> DataFrame:
    """Latest stored time per series."""
    return stored.groupBy(*series).agg(F.max(ms).alias("latest_ms"))


def start_bound_filter(rows: DataFrame, ms: str, bound: Column) -> DataFrame:
    """Rows at or after the bound; a null bound keeps all."""
    return rows.where(bound.isNull() | (F.col(ms) >= bound))


def tail_delta(
    landing: DataFrame,
    latest: DataFrame,
    series: list[str],
    ms: str,
    step_ms: int,
    end_ms: int,
    bound: Column,
) -> DataFrame:
    """Landed rows after each series' newest stored one.

    The start is ``latest + step_ms`` or the bound, whichever is later. A series with nothing stored takes
    everything from its bound, or all its history when it has none. ``step_ms`` is the interval for candles and one
    millisecond for trades.
    """
    rows = join_small(landing, latest, series)
    start = F.greatest(F.col("latest_ms") + step_ms, bound)
    wanted = start.isNull() | F.col(ms).between(start, F.lit(end_ms))
    return rows.where(wanted).drop("latest_ms")


def bounded_bootstrap(
    landing: DataFrame, key: list[str], ms: str, end_ms: int, bound: Column, order: list[str]
) -> DataFrame:
    """First load of a series: rows from the bound to ``end_ms``, the newest delivery of each key."""
    return keep_latest(landing.where(F.col(ms).between(bound, F.lit(end_ms))), key, order)


def full_gap_fill(
    landing: DataFrame,
    stored: DataFrame,
    series: list[str],
    ms: str,
    interval_ms: int,
    end_ms: int,
    bound: Column,
    clip_to_bound: bool = False,
) -> DataFrame:
    """Landed rows that fall into a gap of the stored series (inside it, after it, or before it down to the bound).

    A time lies in a gap when it is at least one interval away from every stored time. Only stored times of its own
    and the two neighbouring buckets can be closer, so each stored bucket is announced to itself and its neighbours,
    that is reduced to one row per bucket, and landed rows meet it by equality: no range join, and no key with more
    than one row on the stored side. ``clip_to_bound`` also drops rows before the bound (trades).
    """
    width = F.lit(interval_ms)
    buckets = interval_buckets(stored.where(F.col(ms) <= end_ms), series, ms, interval_ms)
    shifts = F.array(F.lit(-interval_ms), F.lit(0), F.lit(interval_ms))
    around = (
        buckets.withColumn("_shift", F.explode(shifts))
        .groupBy(*series, (F.col("_bucket") + F.col("_shift")).alias("_bucket"))
        .agg(
            F.max(F.col("_shift") == 0).alias("_same"),
            F.max(F.when(F.col("_shift") > 0, F.col("_hi"))).alias("_before"),
            F.min(F.when(F.col("_shift") < 0, F.col("_lo"))).alias("_after"),
        )
    )
    ends = stored.groupBy(*series).agg(F.min(ms).alias("_first"))
    t = F.col(ms)
    rows = join_small(landing, ends, series).withColumn("_bucket", t - F.pmod(t, width))
    rows = rows.join(around, [*series, "_bucket"], "left")
    clear = (
        ~F.coalesce(F.col("_same"), F.lit(False))
        & F.coalesce(t - F.col("_before") >= width, F.lit(True))
        & F.coalesce(F.col("_after") - t >= width, F.lit(True))
    )
    inside = (t > F.col("_first")) | F.coalesce(t >= bound, F.lit(False))
    open_series = F.when(bound.isNull(), F.lit(True)).otherwise(t.between(bound, F.lit(end_ms)))
    has_stored = (F.col("_first") <= end_ms) & (t <= end_ms) & clear & inside
    wanted = F.when(F.col("_first").isNull(), open_series).otherwise(has_stored)
    if clip_to_bound:
        wanted = wanted & (bound.isNull() | (t >= bound))
    return rows.where(wanted).select(*landing.columns)
