"""Bronze to silver: cleaning, keep-latest, bars and as-of features over all symbols and months."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelake.functions.symbols import base_asset, canon_symbol, dash_symbol
from tidelake.functions.times import at, utc
from tidelake.operators import asof, quality
from tidelake.operators.bars import trade_bars
from tidelake.operators.dedup import keep_latest
from tidelake.schemas import FUNDING_KEY, OHLCV_KEY, OI_KEY, SILVER_COLUMNS, TRADE_KEY
from tidelake.sources.lake import STORED_ORDER, scan_lake, write_silver
from tidelake.sources.manifests import manifest_silver, write_manifests

# fixed values: native funding interval and the verdict on kept rows
FUNDING_INTERVAL_HOURS = 8
KEPT = "ok"


# ---- candles --------------------------------------------------------------------------------------


def ohlcv_clean(bronze: DataFrame) -> DataFrame:
    rules = {"null": quality.ohlc_null_price(), "invalid": quality.ohlc_invalid()}
    return keep_latest(quality.keep_valid(bronze, rules), OHLCV_KEY, STORED_ORDER)


def ohlcv_report(bronze: DataFrame, dataset: str) -> DataFrame:
    return quality.silver_report(
        bronze,
        dataset,
        quality.ohlc_null_price(),
        quality.ohlc_invalid(),
        OHLCV_KEY,
        "open_time",
        ["exchange", "symbol"],
    )


# ---- trades ---------------------------------------------------------------------------------------


def type_trades(bronze: DataFrame) -> DataFrame:
    """Types and lower-case keys of bronze ticks."""
    lowered = {c: F.lower(F.col(c).cast("string")) for c in ("side", "exchange", "instrument_type")}
    return bronze.withColumns(
        {
            "trade_time": utc(F.col("open_time")),
            "price": F.col("price").cast("double"),
            "quantity": F.col("quantity").cast("double"),
            "trade_id": F.col("trade_id").cast("string"),
            **lowered,
        }
    )


def trades_observed(bronze: DataFrame, by_instrument: bool = False) -> DataFrame:
    """Valid ticks, the latest delivery of each trade.

    Option trades share the key of perp trades (underlying, time, id); ``by_instrument`` adds the contract name.
    """
    extra = ["instrument_name"] if by_instrument else []
    valid = quality.keep_valid(type_trades(bronze), {"invalid": quality.trade_invalid()})
    kept = keep_latest(valid, [*TRADE_KEY, *extra], [*STORED_ORDER, "price", "quantity"])
    return kept.select(*SILVER_COLUMNS["trades_observed"], *extra)


def trades_report(bronze: DataFrame, dataset: str) -> DataFrame:
    return quality.silver_report(
        type_trades(bronze),
        dataset,
        F.lit(False),
        quality.trade_invalid(),
        TRADE_KEY,
        "trade_time",
        ["exchange", "symbol"],
    )


def trades_1m_feature(observed: DataFrame) -> DataFrame:
    return trade_bars(observed)


# ---- funding --------------------------------------------------------------------------------------


def type_funding(bronze: DataFrame) -> DataFrame:
    return bronze.withColumns(
        {
            "funding_time": utc(F.col("open_time")),
            "funding_rate": F.col("funding_rate").cast("double"),
            "ingested_at": utc(F.col("ingested_at")),
        }
    )


def funding_observed(bronze: DataFrame, built_at: datetime | str | Column) -> DataFrame:
    """One row per funding time: the latest delivered rate and what it was built from."""
    perp = type_funding(bronze).where("instrument_type = 'perp'")
    valid = quality.keep_valid(perp, {"null": quality.funding_null(), "invalid": quality.funding_invalid()})
    newest = F.struct(*STORED_ORDER)
    clock = built_at if isinstance(built_at, Column) else at(built_at)
    return (
        valid.groupBy(*FUNDING_KEY)
        .agg(
            F.max_by("funding_rate", newest).alias("funding_rate"),
            F.max_by("instrument_type", newest).alias("instrument_type"),
            F.min("ingested_at").alias("ingested_at_min"),
            F.max("ingested_at").alias("ingested_at_max"),
            F.count(F.lit(1)).alias("source_row_count"),
        )
        .withColumns(
            {
                "base_asset": base_asset(F.col("symbol")),
                "funding_interval_hours": F.lit(FUNDING_INTERVAL_HOURS).cast("bigint"),
                "silver_built_at": clock,
                "data_quality_status": F.lit(KEPT),
            }
        )
        .select(*SILVER_COLUMNS["funding_observed"])
    )


def funding_report(bronze: DataFrame) -> DataFrame:
    """Rows in count all instruments; everything else counts perp rows only."""
    return quality.silver_report(
        type_funding(bronze),
        "funding_observed",
        quality.funding_null(),
        quality.funding_invalid(),
        FUNDING_KEY,
        "funding_time",
        ["exchange", "symbol"],
        in_scope=F.col("instrument_type") == "perp",
    )


def funding_1m_feature(observed: DataFrame, cutoff: datetime | str | None = None) -> DataFrame:
    """Last known funding rate for every minute up to the month's last observation (or ``cutoff``, by default now)."""
    until = at(cutoff) if cutoff is not None else F.current_timestamp()
    filled = asof.minute_asof(
        observed, ["exchange", "symbol"], "funding_time", ["funding_rate"], ["ingested_at_max"], until, "timestamp"
    ).withColumnsRenamed({"funding_rate": "funding_rate_last_known", "funding_time": "funding_observed_at"})
    guarded = quality.no_leakage(filled, "funding_observed_at", "timestamp")
    return asof.funding_flags(guarded).select(*SILVER_COLUMNS["funding_1m_feature"])


# ---- open interest --------------------------------------------------------------------------------


def type_oi(bronze: DataFrame) -> DataFrame:
    typed = bronze.withColumns(
        {
            "timestamp": utc(F.col("open_time")),
            "open_interest": F.col("open_interest").cast("double"),
            "symbol": dash_symbol(F.col("symbol")),
            "exchange": F.lower(F.trim("exchange")),
            "ingested_at": utc(F.col("ingested_at")),
        }
    )
    if "oi_is_observed" in bronze.columns:
        typed = typed.where(F.coalesce("oi_is_observed", F.lit(False)))
    return typed


def oi_observed(bronze: DataFrame) -> DataFrame:
    """Valid observations without exact repeats; two different values at one time both stay."""
    valid = quality.keep_valid(type_oi(bronze), {"invalid": quality.oi_invalid()})
    kept = keep_latest(valid, OI_KEY, STORED_ORDER)
    return kept.withColumn("oi_source_timestamp", F.col("timestamp")).select(*SILVER_COLUMNS["oi_observed"])


def oi_report(bronze: DataFrame) -> DataFrame:
    return quality.silver_report(
        type_oi(bronze),
        "oi_observed",
        F.lit(False),
        quality.oi_invalid(),
        OI_KEY,
        "timestamp",
        ["exchange", "symbol"],
    )


def oi_1m_feature(observed: DataFrame, cutoff: datetime | str | None = None) -> DataFrame:
    until = at(cutoff) if cutoff is not None else F.current_timestamp()
    source = observed.drop("oi_source_timestamp").withColumnRenamed("timestamp", "oi_source_timestamp")
    filled = asof.minute_asof(
        source, ["exchange", "symbol"], "oi_source_timestamp", ["open_interest"], ["ingested_at"], until
    )
    guarded = quality.no_leakage(filled, "oi_source_timestamp", "timestamp_m1")
    return asof.oi_flags(guarded).select(*SILVER_COLUMNS["oi_1m_feature"])


# ---- lake build -----------------------------------------------------------------------------------


def build_silver(
    spark: SparkSession,
    bronze_root: str,
    silver_root: str,
    dataset: str,
    built_at: datetime | str,
    cutoff: datetime | str | None = None,
    months: list[str] | None = None,
    touched: DataFrame | None = None,
) -> DataFrame:
    """Build and write the silver tables of one bronze dataset; returns its report.

    All symbols and months are built unless ``months`` names some, or ``touched(_exchange, _asset, _month)`` names the lower-case
    exchanges, canonical symbols and months to build. The observed table is written first and the feature table is built from
    what was written. Manifest rows of every month written are appended below ``_manifests`` of the silver root.
    """
    from tidelake.sources.lake import read_silver as read_stored

    def pick(rows: DataFrame) -> DataFrame:
        rows = rows.where(F.col("month").isin(months)) if months else rows
        if touched is None:
            return rows
        same = (F.lower("exchange") == F.col("_exchange")) & (canon_symbol(F.col("symbol")) == F.col("_asset")) & (F.col("month") == F.col("_month"))
        return rows.join(touched, same, "left_semi")

    def read_silver(*place: str) -> DataFrame:
        return pick(read_stored(*place))

    def describe(table: str, timeframe: str, time: str, name: str | None = None) -> None:
        try:
            rows = read_silver(spark, silver_root, table, timeframe)
        except ValueError:  # no row was kept, so there is nothing to describe
            return
        facts = manifest_silver(rows.drop("year", "month"), name or table, time, at(built_at))
        write_manifests(facts, f"{silver_root}/_manifests")

    bronze = pick(scan_lake(spark, bronze_root, dataset, months=months)).drop("year", "month", "date")
    if dataset in ("spot", "perp"):
        write_silver(ohlcv_clean(bronze), silver_root, dataset, "1m", "open_time")
        describe(dataset, "1m", "open_time", f"{dataset}_1m")
        return ohlcv_report(bronze, f"{dataset}_1m")
    if dataset in ("perp_trades", "option_trades"):
        write_silver(trades_observed(bronze), silver_root, f"{dataset}_observed", "tick", "trade_time")
        observed = read_silver(spark, silver_root, f"{dataset}_observed", "tick")
        write_silver(trades_1m_feature(observed), silver_root, f"{dataset}_1m_feature", "1m", "timestamp_m1")
        describe(f"{dataset}_observed", "tick", "trade_time")
        describe(f"{dataset}_1m_feature", "1m", "timestamp_m1")
        return trades_report(bronze, f"{dataset}_observed")
    if dataset == "funding":
        write_silver(funding_observed(bronze, built_at), silver_root, "funding_observed", "8h", "funding_time")
        observed = read_silver(spark, silver_root, "funding_observed", "8h")
        feature = funding_1m_feature(observed, cutoff)
        write_silver(feature, silver_root, "funding_1m_feature", "1m", "timestamp")
        describe("funding_observed", "8h", "funding_time")
        describe("funding_1m_feature", "1m", "timestamp")
        return funding_report(bronze)
    if dataset == "oi":
        write_silver(oi_observed(bronze), silver_root, "oi_observed", "1m", "timestamp")
        observed = read_silver(spark, silver_root, "oi_observed", "1m")
        write_silver(oi_1m_feature(observed, cutoff), silver_root, "oi_1m_feature", "1m", "timestamp_m1")
        describe("oi_observed", "1m", "timestamp")
        describe("oi_1m_feature", "1m", "timestamp_m1")
        return oi_report(bronze)
    raise ValueError(f"unknown bronze dataset: {dataset}")
