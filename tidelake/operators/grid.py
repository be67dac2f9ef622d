"""Dense minute grid over several inputs, and the joins onto it."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelake.schemas import GOLD_KEY
from tidelake.session import spread

CHUNK_MINUTES = 1440


def input_bounds(frames: dict[str, DataFrame]) -> DataFrame:
    """First and last minute and row count per input, exchange and symbol (one partial aggregate per input)."""
    parts = [
        frame.groupBy("exchange", "symbol")
        .agg(
            F.min("timestamp_m1").alias("first_minute"),
            F.max("timestamp_m1").alias("last_minute"),
            F.count(F.lit(1)).alias("rows"),
        )
        .withColumn("dataset_type", F.lit(name))
        for name, frame in frames.items()
    ]
    return reduce(lambda a, b: a.unionByName(b), parts)


def joint_span(bounds: DataFrame, required: int) -> DataFrame:
    """Overall span of the symbols that have all ``required`` inputs; symbols lacking one are left out."""
    return (
        bounds.groupBy("exchange", "symbol")
        .agg(
            F.min("first_minute").alias("first_minute"),
            F.max("last_minute").alias("last_minute"),
            F.count_distinct("dataset_type").alias("inputs"),
        )
        .where((F.col("inputs") == required) & F.col("first_minute").isNotNull())
        .drop("inputs")
    )


def minute_grid(spans: DataFrame) -> DataFrame:
    """Every minute from ``first_minute`` to ``last_minute`` per (exchange, symbol).

    Spans are cut into day-long chunks that are spread over the cluster before they become minutes, so years of one
    symbol are not built in one task. Minutes count from the first one, aligned or not.
    """
    steps = F.expr("(unix_micros(last_minute) - unix_micros(first_minute)) div 60000000")
    chunks = (
        spans.withColumn("_steps", steps)
        .withColumn("_chunk", F.explode(F.expr(f"sequence(0L, _steps div {CHUNK_MINUTES})")))
        .repartition(spread(spans.sparkSession), "exchange", "symbol", "_chunk")
    )
    first = F.col("_chunk") * CHUNK_MINUTES
    last = F.least(F.col("_steps"), first + (CHUNK_MINUTES - 1))
    return chunks.withColumn("_step", F.explode(F.sequence(first, last))).select(
        F.expr("timestampadd(MINUTE, cast(_step as int), first_minute)").alias("timestamp_m1"), "exchange", "symbol"
    )


def grid_left_join(grid: DataFrame, frames: dict[str, DataFrame]) -> DataFrame:
    """Left-join every input on (minute, exchange, symbol); all joins share one partitioning."""
    return reduce(lambda left, right: left.join(right, GOLD_KEY, "left"), frames.values(), grid)


def with_minute_column(df: DataFrame) -> DataFrame:
    """Add ``timestamp_m1`` from the first time column present; a table without one is passed through."""
    # fixed values: time columns in order of preference
    found = next((c for c in ("timestamp_m1", "open_time", "timestamp") if c in df.columns), None)
    return df if found in (None, "timestamp_m1") else df.withColumn("timestamp_m1", F.col(found))
