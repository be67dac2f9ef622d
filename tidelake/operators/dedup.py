"""Keep-latest and union operators."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def keep_latest(df: DataFrame, keys: list[str], order: list[str | Column]) -> DataFrame:
    """The row with the greatest ``order`` values per key.

    ``row_number() = 1`` lets Spark drop all but one row per key in each map task before the shuffle, so a group of
    copies that holds much of the table arrives as one row per task.
    """
    newest = Window.partitionBy(*keys).orderBy(*[F.desc(c) if isinstance(c, str) else c.desc() for c in order])
    return df.withColumn("_rank", F.row_number().over(newest)).where("_rank = 1").drop("_rank")


def keep_last_n(df: DataFrame, keys: list[str], order: str, n: int) -> DataFrame:
    """The newest ``n`` rows per key (map tasks keep ``n`` rows per key before the shuffle)."""
    newest = Window.partitionBy(*keys).orderBy(F.desc(order))
    return df.withColumn("_rank", F.row_number().over(newest)).where(F.col("_rank") <= n).drop("_rank")


def union_relaxed(*frames: DataFrame) -> DataFrame:
    """Union by name; columns a frame lacks are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def pad_columns(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Exactly ``columns`` (name to type) in order, with nulls for missing ones."""
    have = set(df.columns)
    return df.select(
        *[(F.col(c) if c in have else F.lit(None)).cast(kind).alias(c) for c, kind in columns.items()]
    )
