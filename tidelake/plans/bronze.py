"""Landed payload pages to bronze partitions."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelake.functions.times import UNIT_MS
from tidelake.sources import landing
from tidelake.sources.lake import scan_lake, sink_bronze
from tidelake.sources.manifests import BRONZE_ARTIFACT, manifest_bronze, write_manifests


def typed_rows(pages: DataFrame, dataset: str, exchange: str) -> DataFrame:
    """Pages of one dataset to typed rows, one per key."""
    if dataset in ("spot", "perp"):
        rows = landing.normalize_klines(pages, UNIT_MS["m"], exchange).withColumn("instrument_type", F.lit(dataset))
        return landing.page_dedup(rows, landing.PAGE_KEYS["candles"])
    normalizers = {
        "funding": landing.normalize_funding,
        "oi": landing.normalize_oi,
        "perp_trades": landing.normalize_trades,
        "option_trades": landing.normalize_option_trades,
    }
    if dataset not in normalizers:
        raise ValueError(f"unknown bronze dataset: {dataset}")
    return landing.page_dedup(normalizers[dataset](pages, exchange), landing.PAGE_KEYS[dataset])


def ingest_pages(
    spark: SparkSession,
    pages: DataFrame,
    root: str,
    dataset: str,
    run_id: str,
    ingested_at: datetime | str,
    exchange: str = "deribit",
) -> DataFrame:
    """Normalise landed pages and upsert them; returns the partitions written.

    Manifest rows of these partitions are appended below ``_manifests`` of the lake.
    """
    written = sink_bronze(spark, typed_rows(pages, dataset, exchange), root, dataset, run_id, ingested_at)
    days = written.select(*BRONZE_ARTIFACT).distinct()
    bounds = written.agg(F.min("date").alias("lo"), F.max("date").alias("hi")).first()
    if bounds.lo is not None:
        stored = scan_lake(spark, root, dataset).where(F.col("date").between(bounds.lo, bounds.hi))
        write_manifests(manifest_bronze(stored.join(days, BRONZE_ARTIFACT, "left_semi"), dataset), f"{root}/_manifests")
    return written
