"""Upserts that readers see whole or not at all."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelake.operators.dedup import union_relaxed
from tidelake.operators.small import settle
from tidelake.schemas import BRONZE_PARTITIONS
from tidelake.sources import lake
from tidelake.sources.commits import DAY, commit_log, live_days, new_commit, scan_versions, version_name, versions_path
from tidelake.sources.manifests import append_manifests, manifest_bronze
from tidelake.sources.paths import read_if_there


def _stored(spark: SparkSession, root: str, dataset_type: str, log: DataFrame | None, touched: DataFrame, months: list[str], lo: str, hi: str) -> DataFrame:
    """What the lake holds of the touched days: live versions, and plain files of days that no commit names."""
    schema = lake.stored_schema(dataset_type)
    plain = [rows for rows in lake.scan_layouts(spark, root, dataset_type, schema, months=months) if rows is not None]
    parts = [rows.where(F.col("date").between(lo, hi)).join(touched, DAY, "left_semi") for rows in plain]
    if log is not None:
        live = settle(live_days(log.where(F.col("date").between(lo, hi))).join(touched, DAY, "left_semi"), "live-days")
        parts = [rows.join(live.select(*DAY), DAY, "left_anti") for rows in parts]
        versions = scan_versions(spark, root, dataset_type, schema, live, months=months)
        parts += [] if versions is None else [versions.where(F.col("date").between(lo, hi))]
    return union_relaxed(spark.createDataFrame([], schema), *parts)


def upsert_atomic(spark: SparkSession, new: DataFrame, root: str, dataset_type: str, key: str | None = None) -> DataFrame:
    """Merge bronze rows into their days; returns the days published and their rows.

    Touched days are read, merged and written as new versions, and one commit makes all of them live: a reader meets all
    of the batch or nothing of it, during the write and after a crash. A batch that died is run again as it is; nothing needs
    to be finished first. With ``key``, a batch whose key is in the log already changes nothing. Days stored as plain files
    move to a version when a batch touches them; their old files stay and are no longer read. Batches that touch the same day
    must follow each other; others may run at the same time. Rows without ``open_time`` are refused.
    """
    log = commit_log(spark, root, dataset_type)
    if key is not None and log is not None:
        known = log.where(F.col("key") == key)
        if not known.isEmpty():
            return known.select(*BRONZE_PARTITIONS, "rows")
    fresh = settle(lake.with_partitions(new), "batch")
    span = fresh.agg(
        F.min("date").alias("lo"), F.max("date").alias("hi"), F.count_if(F.col("open_time").isNull()).alias("timeless"), F.collect_set("month").alias("months")
    ).first()
    if span.timeless:
        raise ValueError(f"{span.timeless} rows without open_time; they belong to no day")
    if span.lo is None:
        return spark.createDataFrame([], fresh.schema).groupBy(*BRONZE_PARTITIONS).agg(F.count(F.lit(1)).alias("rows"))
    touched = settle(fresh.select(*DAY).distinct(), "touched")
    stored = _stored(spark, root, dataset_type, log, touched, sorted(span.months), span.lo, span.hi)
    commit = new_commit(spark, root, dataset_type)
    parts = [*BRONZE_PARTITIONS, "version"]
    merged = lake.merge_latest(stored, fresh).select(*stored.columns).withColumn("version", version_name(commit))
    # Adaptive execution sizes the files: small days share a task, a hot day is split.
    merged.hint("rebalance", *parts).sortWithinPartitions(*parts, "open_time").write.partitionBy(*parts).parquet(versions_path(root, commit))
    days = batch_rows(spark, root, dataset_type, commit).groupBy(*parts).agg(
        F.count(F.lit(1)).alias("rows"), F.min("open_time").alias("first_time"), F.max("open_time").alias("last_time")
    )
    # One file, so the commit appears at once; a batch has a row per day here.
    line = days.withColumn("key", F.lit(key).cast("string")).repartition(1)
    line.write.parquet(f"{root}/_commits/{dataset_type}/commit={commit}")
    return committed(spark, root, dataset_type, commit).select(*BRONZE_PARTITIONS, "rows")


def batch_rows(spark: SparkSession, root: str, dataset_type: str, commit: str) -> DataFrame:
    """Rows that one batch has written, with the version of their day."""
    schema = lake.stored_schema(dataset_type).add("version", "string")
    path = versions_path(root, commit)
    return read_if_there(spark, path, path, schema)


def committed(spark: SparkSession, root: str, dataset_type: str, commit: str) -> DataFrame:
    """The log's rows of one commit."""
    return commit_log(spark, root, dataset_type).where(F.col("commit") == commit)


def add_commit_manifests(spark: SparkSession, root: str, dataset_type: str) -> int:
    """Append manifest rows of every commit that has none yet below ``_manifests`` of the lake; returns how many commits.

    A crash between a commit and its manifests is made good by the next call, and no commit is described twice.
    """
    log = commit_log(spark, root, dataset_type)
    if log is None:
        return 0
    done = lake_manifests(spark, root)
    todo = log.select("commit").distinct()
    todo = todo if done is None else todo.join(done.select("commit").distinct(), "commit", "left_anti")
    commits = sorted(r.commit for r in todo.toLocalIterator())
    for commit in commits:
        facts = manifest_bronze(batch_rows(spark, root, dataset_type, commit), dataset_type)
        append_manifests(facts.withColumn("commit", F.lit(commit)), f"{root}/_manifests", ["commit"])
    return len(commits)


def lake_manifests(spark: SparkSession, root: str) -> DataFrame | None:
    from tidelake.sources.manifests import read_manifests

    return read_manifests(spark, f"{root}/_manifests", "commit string")
