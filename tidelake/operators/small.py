"""Tables that are written to the shared scratch folder before they are used further."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tidelake.session import scratch_dir


def settle(df: DataFrame, label: str = "settled") -> DataFrame:
    """``df`` written once and read back.

    The rows are computed a single time, survive lost executors, and the planner knows their true size. A session
    cache would not do: it is found again by plan, so a later read of the same, by then changed, folder could meet
    rows of the past.
    """
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def join_small(big: DataFrame, small: DataFrame, on: list[str], how: str = "left") -> DataFrame:
    """Join with an aggregate that has one row per series, or per series and day.

    No broadcast is forced: as the settled table's size is known, the planner broadcasts it while it is below
    ``spark.sql.autoBroadcastJoinThreshold`` and otherwise shuffles, where adaptive execution splits hot keys.
    """
    return big.join(settle(small, "small"), on, how)
