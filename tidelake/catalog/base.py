"""Market-shaped feeds derived from the given tables, and the query registry.

Every feed covers its whole table row by row. Faults (missing and negative prices, repeats, late corrections) follow
from column values: ``k`` in ``events.props`` and flags of ``lineitem``. :mod:`tidelake.catalog.sql` states the same
feeds in SQL.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelake.functions.times import one_minute, trunc_minute
from tidelake.operators.dedup import pad_columns
from tidelake.schemas import BRONZE_SCHEMAS, ORIGIN_FIELDS
from tidelake.session import scratch_dir, use_lake_settings

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, tuple[str, tuple[str, ...]]] = {}

EXCHANGE = "deribit"
FAR_CUTOFF = "2100-01-01 00:00:00"
_silver_roots: dict[tuple[str, tuple[str, int], str], str] = {}


def publish(df: DataFrame) -> DataFrame:
    """Times as zone-less timestamps, the type the SQL side has."""
    return df.select(
        *[
            F.col(f.name).cast("timestamp_ntz").alias(f.name) if isinstance(f.dataType, T.TimestampType) else F.col(f.name)
            for f in df.schema
        ]
    )


def rounded(df: DataFrame, digits: int, *names: str) -> DataFrame:
    """Sums and means depend on addition order in their last digits."""
    return df.withColumns({n: F.round(n, digits) for n in names})


def query(name: str, sql: str | None = None, *ctes: str):
    """Register a query; ``sql`` is its SELECT over the named feeds and steps of the SQL side."""

    def register(fn: Callable[[Feeds], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return publish(fn(Feeds(use_lake_settings(spark), sf_dir)))

        run.__name__ = name
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = (sql, ctes)
        return fn

    return register


class Feeds:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    @functools.cached_property
    def content(self) -> tuple[str, int]:
        """The data folder and what its files are now, so that tables kept from a query before are not those of older files."""
        files = self.spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true").load(self.sf_dir)
        return self.sf_dir, files.agg(F.bit_xor(F.xxhash64("path", "modificationTime", "length"))).first()[0] or 0

    def table(self, name: str, *columns: str) -> DataFrame:
        """Columns (or all) of a given table; how it is split is left to ``spark.sql.files.maxPartitionBytes``."""
        rows = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return rows.select(*columns) if columns else rows

    def events(self) -> DataFrame:
        asset = F.pmod("user_id", F.lit(3))
        rows = self.table("events", "event_id", "ts", "user_id", "event_type", "value", "props")
        # json_tuple reads each text once, however many rules look at k later on
        return rows.select("*", F.json_tuple("props", "k").alias("k_text")).select(
            "event_id",
            F.col("ts").cast("timestamp").alias("ts"),
            "event_type",
            "value",
            F.col("k_text").cast("bigint").alias("k"),
            F.when(asset == 0, "BTC").when(asset == 1, "ETH").otherwise("SOL").alias("asset"),
        )

    # ---- bronze feeds -----------------------------------------------------------------------------

    def _ticks(self, dataset: str, instrument: str, symbol: Column, endpoint: str, **more: Column) -> DataFrame:
        """Events as ticks, with a second, later and corrected delivery of every click."""
        k, kind = F.col("k"), F.col("event_type")
        price = (
            F.when(k == 13, F.lit(None).cast("double"))
            .when(k == 7, -F.col("value"))
            .when(k == 3, F.lit(float("nan")))
            .when(k == 4, F.lit(float("inf")))
            .otherwise(F.col("value"))
        )
        once = self.events().select(
            "ts",
            symbol.alias("symbol"),
            F.col("event_id").cast("string").alias("trade_id"),
            price.alias("price"),
            k.cast("double").alias("quantity"),
            F.when(kind == "purchase", "BUY").when(kind == "click", "sell").otherwise("unknown").alias("side"),
            (kind == "error").alias("is_maker"),
            *[c.alias(n) for n, c in more.items()],
            F.explode(F.when(kind == "click", F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("d"),
        )
        first = F.col("d") == 0
        return once.select(
            F.lit("v1").alias("schema_version"),
            F.lit(dataset).alias("dataset_type"),
            F.when(first, EXCHANGE.upper()).otherwise(EXCHANGE).alias("exchange"),
            "symbol",
            F.when(first, instrument.upper()).otherwise(instrument).alias("instrument_type"),
            F.col("ts").alias("event_time"),
            (F.col("ts") + F.expr("make_dt_interval(0, d, 0, 1)")).alias("ingested_at"),
            F.concat(F.lit("run-"), F.col("d").cast("string")).alias("run_id"),
            F.lit(endpoint).alias("source_endpoint"),
            F.col("ts").alias("open_time"),
            F.col("ts").alias("close_time"),
            F.lit("tick").alias("timeframe"),
            "trade_id",
            (F.col("price") + F.col("d")).alias("price"),
            "quantity",
            "side",
            "is_maker",
            *more,
        )

    def ticks(self) -> DataFrame:
        return self._ticks("perp_trades", "perp", F.concat("asset", F.lit("-PERPETUAL")), "public_trades")

    @staticmethod
    def option_name() -> Column:
        day = F.upper(F.date_format("ts", "ddMMMyy"))
        kind = (
            F.when(F.col("event_type").isin("click", "purchase"), "C")
            .when(F.col("event_type") == "view", "P")
            .when(F.col("event_type") == "signup", "p")
            .otherwise("X")
        )
        strike = F.when(F.col("k") == 13, F.lit("abc")).otherwise((F.col("k") * 1000).cast("string"))
        return F.when(F.col("k") == 7, F.concat("asset", F.lit("-PERPETUAL"))).otherwise(
            F.concat_ws("-", "asset", day, strike, kind)
        )

    def option_ticks(self) -> DataFrame:
        from tidelake.functions.symbols import option_fields

        rows = self._ticks(
            "option_trades", "option", F.col("asset"), "public_option_trades", instrument_name=self.option_name()
        )
        return rows.withColumn("_o", option_fields(F.col("instrument_name"))).select(*rows.columns, "_o.*")

    def candles(self) -> DataFrame:
        """Raw candles of both markets, one per line item; returned items are delivered again with a corrected close."""
        columns = [
            "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount",
            "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
        ]
        price, part = F.col("l_extendedprice"), F.pmod("l_suppkey", F.lit(3))
        asset = F.when(part == 0, "BTC").when(part == 1, "ETH").otherwise("SOL")
        spot = F.col("l_linestatus") == "F"
        low = price * (1 - F.col("l_discount"))
        twice = F.when(F.col("l_returnflag") == "R", F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
        once = self.table("lineitem", *columns).select(
            F.concat(asset, F.when(spot, "_USDC").otherwise("-PERPETUAL")).alias("symbol"),
            F.when(spot, "spot").otherwise("perp").alias("market"),
            F.expr("cast(l_shipdate as timestamp) + make_dt_interval(0, 0, cast(pmod(l_partkey, 1440) as int))").alias("t"),
            F.when(F.col("l_quantity") != 13, price).alias("open_price"),
            F.when(F.col("l_linenumber") == 7, low - 1).otherwise(price * (1 + F.col("l_tax"))).alias("high_price"),
            low.alias("low_price"),
            "l_orderkey",
            "l_quantity",
            "l_linenumber",
            F.concat_ws("-", F.lit("run"), "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("run"),
            F.explode(twice).alias("d"),
        )
        return once.select(
            F.lit("v1").alias("schema_version"),
            F.col("market").alias("dataset_type"),
            F.lit(EXCHANGE).alias("exchange"),
            "symbol",
            F.col("market").alias("instrument_type"),
            F.col("t").alias("event_time"),
            F.expr("t + make_dt_interval(0, d, 1, cast(l_orderkey as decimal(18,6)))").alias("ingested_at"),
            F.concat_ws("-", "run", "d").alias("run_id"),
            F.lit("public_market_data").alias("source_endpoint"),
            F.col("t").alias("open_time"),
            (F.col("t") + F.expr("interval '59.999' second")).alias("close_time"),
            F.lit("1m").alias("timeframe"),
            "open_price",
            "high_price",
            "low_price",
            (F.col("low_price") + F.col("d") * F.lit(0.5)).alias("close_price"),
            F.col("l_quantity").alias("volume"),
            F.lit(None).cast("double").alias("quote_volume"),
            F.col("l_linenumber").cast("bigint").alias("trade_count"),
        )

    def minute_candles(self, market: str) -> DataFrame:
        """Each event as a raw candle of its minute (perp: the next minute); the last event of a minute survives."""
        k, spot = F.col("k"), market == "spot"
        value = F.col("value") * (1.0 if spot else 1.001)
        opened = trunc_minute(F.col("ts")) if spot else trunc_minute(F.col("ts")) + one_minute()
        rows = self.events().select(
            F.lit("v1").alias("schema_version"),
            F.lit(market).alias("dataset_type"),
            F.lit(EXCHANGE).alias("exchange"),
            F.concat("asset", F.lit("_USDC" if spot else "-PERPETUAL")).alias("symbol"),
            F.lit(market).alias("instrument_type"),
            opened.alias("event_time"),
            F.col("ts").alias("ingested_at"),
            F.concat(F.lit("run-"), F.col("event_id").cast("string")).alias("run_id"),
            F.lit("public_market_data").alias("source_endpoint"),
            opened.alias("open_time"),
            (opened + F.expr("interval '59.999' second")).alias("close_time"),
            F.lit("1m").alias("timeframe"),
            F.when(k != 13, value).alias("open_price"),
            F.when(k == 7, value - 5).otherwise(value + 2).alias("high_price"),
            (value - 1).alias("low_price"),
            F.when(k == 3, F.lit(float("nan"))).otherwise(value + 1).alias("close_price"),
            k.cast("double").alias("volume"),
            F.lit(None).cast("double").alias("quote_volume"),
            F.lit(0).cast("bigint").alias("trade_count"),
        )
        origin = [F.col("timeframe" if f == "interval" else f).alias(f) for f in ORIGIN_FIELDS]
        return rows.withColumn("origin_payload", F.struct(*origin))

    def funding(self) -> DataFrame:
        """Each event as a funding observation; some on whole minutes, some delivered twice."""
        k = F.col("k")
        twice = F.when(k >= 90, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
        whole = F.col("event_type").isin("signup", "view")
        rate = (
            F.when(k == 13, F.lit(None).cast("double"))
            .when(k == 7, F.lit(1.5))
            .when(k == 3, F.lit(float("nan")))
            .otherwise(F.col("value") / 1000 + F.col("d") * F.lit(0.25))
        )
        when = F.when(whole, trunc_minute(F.col("ts"))).otherwise(F.col("ts"))
        rows = self.events().withColumn("d", F.explode(twice)).select(
            F.lit("v1").alias("schema_version"),
            F.lit("funding").alias("dataset_type"),
            F.lit(EXCHANGE).alias("exchange"),
            F.concat("asset", F.lit("-PERPETUAL")).alias("symbol"),
            F.when(k == 50, "spot").otherwise("perp").alias("instrument_type"),
            when.alias("event_time"),
            (F.col("ts") + F.expr("make_dt_interval(0, d, 0, 1)")).alias("ingested_at"),
            F.concat(F.lit("run-"), F.col("event_id").cast("string")).alias("run_id"),
            F.lit("public_funding").alias("source_endpoint"),
            when.alias("open_time"),
            when.alias("close_time"),
            F.lit("8h").alias("timeframe"),
            rate.alias("funding_rate"),
            F.col("value").alias("index_price"),
            (F.col("value") + 1).alias("mark_price"),
        )
        return pad_columns(rows, {f.name: f.dataType.simpleString() for f in BRONZE_SCHEMAS["funding"]})

    def oi(self) -> DataFrame:
        """Each event as an open-interest observation with loosely written names; repeats, nulls and negatives."""
        k = F.col("k")
        twice = F.when(k >= 90, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
        whole = F.col("event_type").isin("view", "purchase")
        when = F.when(whole, trunc_minute(F.col("ts"))).otherwise(F.col("ts"))
        value = (
            F.when(k == 13, F.lit(None).cast("double"))
            .when(k == 7, -F.col("value"))
            .when(k == 3, F.lit(float("inf")))
            .otherwise(F.col("value") * 100)
        )
        name = (
            F.when(k == 5, F.lit("  "))
            .when(k == 6, F.lit(None).cast("string"))
            .when(F.col("event_type") == "error", F.concat(F.lower("asset"), F.lit("_perpetual")))
            .when(F.col("event_type") == "signup", F.concat(F.lit(" "), "asset", F.lit(" / PERPETUAL ")))
            .otherwise(F.concat("asset", F.lit("-PERPETUAL")))
        )
        rows = self.events().withColumn("d", F.explode(twice)).select(
            F.lit("v1").alias("schema_version"),
            F.lit("oi").alias("dataset_type"),
            F.when(F.col("event_type") == "error", " Deribit ").otherwise(EXCHANGE).alias("exchange"),
            name.alias("symbol"),
            F.lit("perp").alias("instrument_type"),
            when.alias("event_time"),
            (F.col("ts") + F.expr("make_dt_interval(0, d, 0, 1)")).alias("ingested_at"),
            F.concat(F.lit("run-"), F.col("event_id").cast("string")).alias("run_id"),
            F.lit("public_open_interest").alias("source_endpoint"),
            when.alias("open_time"),
            when.alias("close_time"),
            F.lit("1m").alias("timeframe"),
            value.alias("open_interest"),
            F.lit(0.0).alias("open_interest_value"),
        )
        return rows

    def l2(self) -> DataFrame:
        """Hourly order-book summary rows; busy hours exceed full coverage."""
        return (
            self.events()
            .groupBy(F.date_trunc("hour", "ts").alias("ts_minute"), F.lit(EXCHANGE).alias("exchange"), F.col("asset").alias("symbol"))
            .agg(
                F.count(F.lit(1)).alias("snapshot_count"),
                (F.count(F.lit(1)) / F.lit(10.0)).alias("coverage_ratio"),
                F.min("ts").alias("first_snapshot_ts"),
                F.max("ts").alias("last_snapshot_ts"),
                (F.max("value") - F.min("value")).alias("spread"),
            )
        )

    # ---- silver tables for gold -------------------------------------------------------------------

    def silver(self, name: str) -> DataFrame:
        """A silver table as gold reads it: written once per session and data folder, then read from the lake."""
        from tidelake.sources.lake import read_silver, write_silver

        if name == "gold_l2_m1":
            return self.l2()
        key = (self.spark.sparkContext.applicationId, self.content, name)
        if key not in _silver_roots:
            root = scratch_dir(self.spark, "silver")
            time = {"spot": "open_time", "perp": "open_time", "funding_1m_feature": "timestamp"}.get(name, "timestamp_m1")
            write_silver(self.silver_steps(name), root, name, "1m", time)
            _silver_roots[key] = root
        return read_silver(self.spark, _silver_roots[key], name, "1m").drop("year", "month")

    def silver_steps(self, name: str) -> DataFrame:
        """The same table as one plan from the bronze feed."""
        from tidelake.plans import silver

        if name in ("spot", "perp"):
            return silver.ohlcv_clean(self.minute_candles(name))
        if name == "oi_1m_feature":
            return silver.oi_1m_feature(silver.oi_observed(self.oi()), FAR_CUTOFF)
        if name == "funding_1m_feature":
            return silver.funding_1m_feature(silver.funding_observed(self.funding(), FAR_CUTOFF), FAR_CUTOFF)
        if name == "perp_trades_1m_feature":
            return silver.trades_1m_feature(silver.trades_observed(self.ticks()))
        if name == "option_trades_1m_feature":
            return silver.trades_1m_feature(silver.trades_observed(self.option_ticks()))
        raise KeyError(name)
