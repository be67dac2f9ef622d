"""Manifest tables: one row per written artifact."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelake.functions.hashing import columns_hash, json_hash, value_checksum
from tidelake.functions.times import iso_utc, month_part
from tidelake.operators.governance import contract
from tidelake.operators.profile import metadata_json, metadata_parts
from tidelake.operators.small import settle
from tidelake.schemas import BRONZE_SCHEMAS, JOIN_POLICY_OLD

BRONZE_ARTIFACT = ["dataset_type", "exchange", "instrument_type", "symbol", "timeframe", "date"]


def _text_array(values: list[str]) -> Column:
    return F.array(*[F.lit(v) for v in values]).cast("array<string>")


def manifest_bronze(stored: DataFrame, dataset_type: str) -> DataFrame:
    """Row per day partition: rows, columns, time span, the hash over those, a checksum of the values, facts per column.

    ``source_data_hash`` sees the shape only, as its definition says; ``value_checksum`` changes with the values.
    """
    columns = [f.name for f in BRONZE_SCHEMAS[dataset_type]]
    plain = [f for f in BRONZE_SCHEMAS[dataset_type] if f.name != "origin_payload"]
    aggs, cells = metadata_parts(stored.select(*columns), "open_time")
    spans = stored.groupBy(*BRONZE_ARTIFACT).agg(
        F.count(F.lit(1)).alias("_rows"),
        *aggs,
        iso_utc(F.min("open_time")).alias("min_timestamp"),
        iso_utc(F.max("open_time")).alias("max_timestamp"),
        value_checksum(plain).cast("string").alias("value_checksum"),
    ).withColumn("rows_out", F.col("_rows"))
    listed = _text_array(columns)
    shape = F.struct(listed.alias("columns"), "max_timestamp", "min_timestamp", "rows_out")
    return spans.select(
        F.lit(f"{dataset_type}_1m").alias("dataset"),
        *BRONZE_ARTIFACT,
        "rows_out",
        listed.alias("columns"),
        "min_timestamp",
        "max_timestamp",
        json_hash(shape).alias("source_data_hash"),
        "value_checksum",
        metadata_json(cells).alias("feature_metadata"),
    )


def missing_manifests(days: DataFrame, manifests: DataFrame) -> DataFrame:
    """Day partitions without a manifest row; ``days`` come from :func:`tidelake.sources.lake.list_partitions`, which opens no file."""
    return days.select(*BRONZE_ARTIFACT).distinct().join(manifests.select(*BRONZE_ARTIFACT), BRONZE_ARTIFACT, "left_anti")


def manifests_to_add(days: DataFrame, stored: DataFrame, manifests: DataFrame, dataset_type: str) -> DataFrame:
    """Manifest rows for the partitions among ``days`` that lack one; ``stored`` is read for these alone, as far as dates tell."""
    lacking = settle(missing_manifests(days, manifests), "lacking")
    dates = sorted(r.date for r in lacking.select("date").distinct().collect())
    return manifest_bronze(stored.where(F.col("date").isin(dates)).join(lacking, BRONZE_ARTIFACT, "left_semi"), dataset_type)


def manifest_silver(frame: DataFrame, dataset: str, time: str, built_at: Column) -> DataFrame:
    """Row per exchange, symbol and month of a silver table, with facts per column and the table as its source."""
    columns = frame.columns
    listed = _text_array(columns)
    aggs, cells = metadata_parts(frame, time)
    source = F.struct(F.struct(listed.alias("columns"), F.col("_rows").alias("rows"), F.array("symbol").alias("source_symbols")).alias(dataset))
    return (
        frame.withColumn("_month", month_part(F.col(time)))
        .groupBy("exchange", "symbol", "_month")
        .agg(
            F.count(F.lit(1)).alias("_rows"),
            *aggs,
            iso_utc(F.min(time)).alias("_first"),
            iso_utc(F.max(time)).alias("_last"),
        )
        .select(
            F.lit(dataset).alias("dataset"),
            "exchange",
            "symbol",
            F.col("_month").alias("month"),
            iso_utc(built_at).alias("build_date_utc"),
            columns_hash(listed).alias("column_hash"),
            F.col("_rows").alias("rows_out"),
            listed.alias("columns"),
            F.col("_first").alias("min_timestamp"),
            F.col("_last").alias("max_timestamp"),
            F.to_json(source).alias("source_silver_datasets"),
            metadata_json(cells).alias("feature_metadata"),
        )
    )


def write_manifests(rows: DataFrame, root: str) -> None:
    """Append manifest rows as JSON lines."""
    rows.write.mode("append").json(root)


def append_manifests(rows: DataFrame, root: str, key: list[str]) -> None:
    """Append the manifest rows whose ``key`` no row has yet, so that a write that is run again adds nothing."""
    there = read_manifests(rows.sparkSession, root, ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in key))
    write_manifests(rows if there is None else rows.join(there.distinct(), key, "left_anti"), root)


def read_manifests(spark: SparkSession, root: str, schema: str) -> DataFrame | None:
    """Manifest rows, without the lines that are not valid JSON; none when the folder does not exist."""
    broken = "_broken string"
    reader = spark.read.schema(f"{schema}, {broken}").option("mode", "PERMISSIVE")
    try:
        rows = reader.option("columnNameOfCorruptRecord", "_broken").json(root)
    except AnalysisException as problem:
        if problem.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    return rows.where("_broken is null").drop("_broken")


def with_contract(manifests: DataFrame) -> DataFrame:
    """Fill ``contract`` of manifests written before contracts existed from their column and source lists."""
    old = contract(F.col("columns"), F.col("source_dataset_keys"), F.lit(JOIN_POLICY_OLD))
    return manifests.withColumn("contract", F.coalesce("contract", old))

