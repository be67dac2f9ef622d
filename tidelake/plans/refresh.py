"""Silver that follows the commits of a bronze lake."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelake.functions.symbols import canon_symbol
from tidelake.operators.small import settle
from tidelake.plans.silver import build_silver
from tidelake.sources.commits import commit_log
from tidelake.sources.paths import read_if_there

_DONE = T.StructType([T.StructField("commit", T.StringType())])


def silver_refresh(
    spark: SparkSession, bronze_root: str, silver_root: str, dataset: str, built_at: datetime | str, cutoff: datetime | str | None = None
) -> DataFrame:
    """Rebuild the silver months that commits since the last refresh have touched; returns these (exchange, symbol, month).

    Every commit says which series and months it published, so only those are read again, in all spellings that bronze has
    for a symbol. Commits taken in are recorded below ``_progress`` of the silver root after the tables are written: a refresh
    that died is run again and builds the same months. A month whose last valid row was corrected away keeps its old file.
    """
    empty = spark.createDataFrame([], "exchange string, symbol string, month string")
    log = commit_log(spark, bronze_root, dataset)
    if log is None:
        return empty
    progress = f"{silver_root}/_progress/{dataset}"
    done = read_if_there(spark, progress, progress, _DONE)
    new = log.select("commit", "exchange", "symbol", "month")
    new = settle(new if done is None else new.join(done, "commit", "left_anti"), "new-commits")
    touched = settle(new.select(F.lower("exchange").alias("_exchange"), canon_symbol(F.col("symbol")).alias("_asset"), F.col("month").alias("_month")).distinct(), "touched")
    months = sorted(r[0] for r in touched.select("_month").distinct().collect())
    if not months:
        return empty
    build_silver(spark, bronze_root, silver_root, dataset, built_at, cutoff, months, touched)
    new.select("commit").distinct().coalesce(1).write.mode("append").parquet(progress)
    return touched.toDF("exchange", "symbol", "month")
