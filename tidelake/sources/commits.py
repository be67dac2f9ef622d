"""Versions of day partitions, and the log that says which of them are live.

A batch writes the days it touches as new files below ``_versions/batch=<id>``; files that a reader may be at are never
touched. The batch becomes visible as a whole when its commit appears below ``_commits``: one small file with a row per day,
which names the version that is live from then on. The newest commit of a day wins. A batch that dies leaves files that no
commit names; it is simply run again.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelake.operators.dedup import keep_latest
from tidelake.schemas import BRONZE_PARTITIONS, SERIES
from tidelake.sources.paths import choice, list_artifacts, read_if_there

DAY = [*SERIES, "date"]
_LOG = T.StructType(
    [T.StructField(c, T.StringType()) for c in (*BRONZE_PARTITIONS, "version", "key", "commit")]
    + [T.StructField("rows", T.LongType()), T.StructField("first_time", T.TimestampType()), T.StructField("last_time", T.TimestampType())]
)


def commit_log(spark: SparkSession, root: str, dataset_type: str) -> DataFrame | None:
    """Every commit of a dataset, a row per day it published; None before the first one.

    The folder is listed now: what is committed later is not seen through this frame.
    """
    return read_if_there(spark, f"{root}/_commits/{dataset_type}", f"{root}/_commits/{dataset_type}/commit=*", _LOG)


def live_days(log: DataFrame) -> DataFrame:
    """The newest commit of each day."""
    return keep_latest(log, DAY, ["commit"])


def new_commit(spark: SparkSession, root: str, dataset_type: str) -> str:
    """A commit id greater than all in the log; from folder names alone."""
    found = list_artifacts(spark, f"{root}/_commits/{dataset_type}")
    newest = None if found is None else found.agg(F.max(F.regexp_extract("path", r"/commit=([^/]+)/", 1))).first()[0]
    number = int(re.match(r"\d+", newest)[0]) + 1 if newest else 0
    return f"{number:012d}-{uuid.uuid4().hex[:12]}"


def version_name(commit: str):
    """Name of a day's version: unique in the lake, so that a reader's join with the log prunes by it alone."""
    return F.substring(F.sha2(F.concat_ws("\n", F.lit(commit), *DAY), 256), 1, 24)


def versions_path(root: str, commit: str) -> str:
    return f"{root}/_versions/batch={commit}"


def scan_versions(
    spark: SparkSession,
    root: str,
    dataset_type: str,
    schema: T.StructType,
    live: DataFrame,
    exchange: str | None = None,
    instrument_type: str | None = None,
    symbol: str | None = None,
    timeframe: str | None = None,
    months: str | list[str] | None = None,
) -> DataFrame | None:
    """Rows of the versions that ``live`` names. While the planner broadcasts ``live``, other versions' files are not opened."""
    series = (
        f"{root}/_versions/batch=*/dataset_type={dataset_type}/exchange={choice(exchange)}/instrument_type={choice(instrument_type)}"
        f"/symbol={choice(symbol)}/timeframe={choice(timeframe)}"
    )
    stored = T.StructType([*schema, T.StructField("version", T.StringType())])
    rows = read_if_there(spark, f"{root}/_versions", f"{series}/year=*/month={choice(months)}", stored)
    if rows is None:
        return None
    # The comparison says nothing new; it tells the planner that this side selects, which lets it prune the other.
    named = live.where("version > ''").select("version")
    return rows.join(named, "version", "left_semi").select(*schema.names)


def live_paths(log: DataFrame, root: str) -> DataFrame:
    """Live days as paths that :func:`tidelake.sources.lake.parse_partition_path` reads, without a look at the files."""
    levels = [F.concat(F.lit(f"/{c}="), F.col(c)) for c in BRONZE_PARTITIONS]
    return live_days(log).select(F.concat(F.lit(root), *levels, F.lit("/")).alias("path"))


def replaced_versions(spark: SparkSession, root: str, dataset_type: str) -> DataFrame:
    """Versions that a later commit has replaced: (commit, version and the day's columns).

    Nothing here deletes them; who does must leave those that a running reader may still be at.
    """
    log = commit_log(spark, root, dataset_type)
    if log is None:
        return spark.createDataFrame([], _LOG)
    return log.join(live_days(log).select("version"), "version", "left_anti").select(*_LOG.names)
