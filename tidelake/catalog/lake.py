"""Lake layouts, upserts, typed and combined readers, landed payloads, manifests and the streaming load.

Lakes are written to the shared scratch folder from the feeds and read back.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tidelake.catalog import sql as S
from tidelake.catalog.base import EXCHANGE, FAR_CUTOFF, query, rounded
from tidelake.catalog.gold import TRADE_SUMS
from tidelake.catalog.silver import BAR_SUMS
from tidelake.functions.symbols import canon_symbol
from tidelake.functions.times import trunc_minute
from tidelake.operators import governance, profile
from tidelake.plans import combined, gold, silver
from tidelake.plans.bronze import ingest_pages
from tidelake.plans.refresh import silver_refresh as refresh_silver
from tidelake.schemas import (
    BRONZE_PARTITIONS,
    BRONZE_PARTITIONS_OLD,
    BRONZE_SCHEMAS,
    L2_INPUT,
    SILVER_COLUMNS,
)
from tidelake.session import scratch_dir
from tidelake.sources import atomic, lake, landing, manifests
from tidelake.streaming.flush import chunk_flush as flush_stream

_TICK = [f.name for f in BRONZE_SCHEMAS["perp_trades"]]
_CANDLE = [f.name for f in BRONZE_SCHEMAS["spot"] if f.name != "origin_payload"]
_written: dict[tuple[str, tuple[str, int], str], str] = {}


def _cols(names: list[str]) -> str:
    return ", ".join(names)


def _days(df, root: str, partitions: list[str] = BRONZE_PARTITIONS) -> None:
    rows = lake.with_partitions(df)
    rows = rows if "year" in partitions else rows.drop("year")
    writer = rows.hint("rebalance", *partitions).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*partitions).parquet(root)


def bronze_lake(f, *datasets: str) -> str:
    """A bronze lake with the feeds of ``datasets`` at least, each written once per session and data folder, when first asked for.

    First deliveries of ticks have the ``year=`` level in their folders, second deliveries lack it.
    """
    own = f.spark.sparkContext.applicationId, f.content
    root = _written.setdefault((*own, "bronze"), scratch_dir(f.spark, "bronze"))
    for dataset in datasets:
        if (*own, dataset) in _written:
            continue
        if dataset == "perp_trades":
            ticks = f.ticks()
            _days(ticks.where("run_id = 'run-0'"), root)
            _days(ticks.where("run_id <> 'run-0'"), root, BRONZE_PARTITIONS_OLD)
        elif dataset == "oi":
            _days(silver.type_oi(f.oi()).where("length(symbol) > 0").drop("timestamp"), root)
        else:
            _days(f.funding() if dataset == "funding" else f.minute_candles(dataset), root)
        _written[(*own, dataset)] = root
    return root


def silver_lake(f) -> str:
    """Silver candles of all line items, by symbol and month."""
    key = (f.spark.sparkContext.applicationId, f.content, "silver")
    if key not in _written:
        root = scratch_dir(f.spark, "silver")
        clean = silver.ohlcv_clean(f.candles())
        for market in ("spot", "perp"):
            lake.write_silver(clean.where(f"dataset_type = '{market}'"), root, market, "1m", "open_time")
        _written[key] = root
    return _written[key]


# ---- scans and discovery --------------------------------------------------------------------------


@query("scan_lake", f"SELECT {_cols(_TICK)}, strftime(open_time, '%Y') AS year, strftime(open_time, '%Y-%m') AS month, strftime(open_time, '%Y-%m-%d') AS date FROM ticks", "ticks")
def scan_lake(f):
    return lake.scan_lake(f.spark, bronze_lake(f, "perp_trades"), "perp_trades")


@query("scan_month", f"SELECT {_cols(_CANDLE)} FROM spot1 WHERE symbol = 'BTC_USDC' AND strftime(open_time, '%Y-%m') = '2024-01'", "spot1")
def scan_month(f):
    month = lake.scan_lake(f.spark, bronze_lake(f, "spot"), "spot", EXCHANGE, "spot", "BTC_USDC", "1m", months="2024-01")
    return month.select(*_CANDLE)


@query("discover_symbols", "SELECT DISTINCT symbol FROM spot1", "spot1")
def discover_symbols(f):
    return lake.discover_symbols(f.spark, bronze_lake(f, "spot"), "spot", EXCHANGE, "1m")


@query("discover_months", "SELECT DISTINCT strftime(open_time, '%Y-%m') AS month FROM ticks WHERE exchange = 'DERIBIT'", "ticks")
def discover_months(f):
    return lake.discover_months(f.spark, bronze_lake(f, "perp_trades"), "perp_trades", "DERIBIT", "BTC-PERPETUAL", "tick")


@query("discover_observed_months", "SELECT DISTINCT symbol, strftime(open_time, '%Y-%m') AS month FROM c_clean WHERE dataset_type = 'perp'", "c_clean")
def discover_observed_months(f):
    return lake.read_silver(f.spark, silver_lake(f), "perp", "1m").select("symbol", "month").distinct()


@query(
    "read_silver_for_gold",
    f"SELECT {_cols([c for c in _CANDLE if c != 'dataset_type'])} FROM c_clean WHERE dataset_type = 'spot' AND symbol = 'ETH_USDC'",
    "c_clean",
)
def read_silver_for_gold(f):
    stored = lake.read_silver(f.spark, silver_lake(f), "spot", "1m").where(canon_symbol(F.col("symbol")) == "ETH")
    return stored.select(*[c for c in _CANDLE if c != "dataset_type"])


@query(
    "write_silver_month",
    """SELECT dataset_type, exchange, symbol, strftime(open_time, '%Y') AS year, strftime(open_time, '%Y-%m') AS month,
      count(*) AS rows, round(sum(close_price), 4) AS close_sum FROM c_clean GROUP BY 1, 2, 3, 4, 5""",
    "c_clean",
)
def write_silver_month(f):
    root = silver_lake(f)
    both = lake.read_silver(f.spark, root, "spot", "1m").unionByName(lake.read_silver(f.spark, root, "perp", "1m"))
    months = both.groupBy("dataset_type", "exchange", "symbol", "year", "month")
    return rounded(months.agg(F.count(F.lit(1)).alias("rows"), F.sum("close_price").alias("close_sum")), 4, "close_sum")


@query(
    "partition_columns",
    """SELECT event_id, strftime(ts, '%Y') AS year, strftime(ts, '%Y-%m') AS month, strftime(ts, '%Y-%m-%d') AS date
    FROM events""",
)
def partition_columns(f):
    return lake.with_partitions(f.events().select("event_id", "ts"), "ts").drop("ts")


@query(
    "parse_partition_path",
    """SELECT dataset_type, exchange, instrument_type, symbol, timeframe, strftime(open_time, '%Y-%m-%d') AS date, count(*) AS rows
    FROM ticks GROUP BY ALL""",
    "ticks",
)
def parse_partition_path(f):
    stored = lake.scan_lake(f.spark, bronze_lake(f, "perp_trades"), "perp_trades")
    path = stored.select(lake.parse_partition_path(F.input_file_name()).alias("p"), "trade_id")
    return path.groupBy("p.dataset_type", "p.exchange", "p.instrument_type", "p.symbol", "p.timeframe", "p.date").agg(
        F.count("trade_id").alias("rows")
    )


@query(
    "stored_open_times",
    "SELECT DISTINCT exchange, instrument_type, symbol, timeframe, open_time FROM spot1",
    "spot1",
)
def stored_open_times(f):
    return lake.stored_open_times(lake.scan_lake(f.spark, bronze_lake(f, "spot"), "spot"))


@query(
    "latest_open_time",
    "SELECT exchange, instrument_type, symbol, timeframe, max(open_time) AS open_time FROM ticks GROUP BY 1, 2, 3, 4",
    "ticks",
)
def latest_open_time(f):
    return lake.latest_open_time(f.spark, bronze_lake(f, "perp_trades"), "perp_trades")


# ---- upsert and sinks -----------------------------------------------------------------------------

_MERGED = "exchange, instrument_type, symbol, timeframe, open_time, trade_id"
S.CTES["ticks_lower"] = (
    ["ticks"],
    "SELECT * REPLACE (lower(exchange) AS exchange, lower(instrument_type) AS instrument_type) FROM ticks",
)


def ticks_lower(f):
    return f.ticks().withColumns({c: F.lower(c) for c in ("exchange", "instrument_type")})


@query("upsert_partitions", S._newest("ticks_lower", _MERGED, "ingested_at DESC, run_id DESC", "TRUE", _cols(_TICK)), "ticks_lower")
def upsert_partitions(f):
    root, ticks = scratch_dir(f.spark, "upsert-target"), ticks_lower(f)
    first, second = ticks.where("run_id = 'run-0'"), ticks.where("run_id <> 'run-0'")
    for batch in (second, first, second):  # late rows first, then the early ones, then the late ones again
        lake.upsert_partitions(f.spark, batch, root, "perp_trades")
    return lake.scan_lake(f.spark, root, "perp_trades").select(*_TICK)


@query("upsert_old_layout", S._newest("ticks_lower", _MERGED, "ingested_at DESC, run_id DESC", "TRUE", _cols(_TICK)), "ticks_lower")
def upsert_old_layout(f):
    """All first deliveries stored without the ``year=`` level, then corrected; a plain scan meets each tick once."""
    root, ticks = scratch_dir(f.spark, "upsert-old"), ticks_lower(f)
    _days(ticks.where("run_id = 'run-0'"), root, BRONZE_PARTITIONS_OLD)
    lake.upsert_partitions(f.spark, ticks.where("run_id <> 'run-0'"), root, "perp_trades")
    return lake.scan_lake(f.spark, root, "perp_trades").select(*_TICK)


@query("dedup_bronze", S._newest("ticks_lower", _MERGED, "ingested_at DESC, run_id DESC", "TRUE", _cols(_TICK)), "ticks_lower")
def dedup_bronze(f):
    ticks = ticks_lower(f)
    return lake.merge_latest(ticks.where("run_id = 'run-0'"), ticks.where("run_id <> 'run-0'")).select(*_TICK)


@query("chunk_flush", S._newest("ticks_lower", _MERGED, "ingested_at DESC, run_id DESC", "TRUE", _cols(_TICK)), "ticks_lower")
def chunk_flush(f):
    base = scratch_dir(f.spark, "flush")
    columns = [F.col(c.name).cast(c.dataType) for c in BRONZE_SCHEMAS["perp_trades"]]
    ticks_lower(f).select(*columns).repartition(3).write.parquet(f"{base}/landing")
    for run in ("a", "b"):  # the second run replays everything under a new checkpoint
        flush_stream(f.spark, f"{base}/landing", f"{base}/lake", "perp_trades", f"{base}/checkpoint-{run}", files_per_batch=2)
    return lake.scan_lake(f.spark, f"{base}/lake", "perp_trades").select(*_TICK)


@query("upsert_atomic", S._newest("ticks_lower", _MERGED, "ingested_at DESC, run_id DESC", "TRUE", _cols(_TICK)), "ticks_lower")
def upsert_atomic(f):
    """Old-layout files of all first deliveries, then the corrections as commits, one of them delivered twice."""
    root, ticks = scratch_dir(f.spark, "upsert-atomic"), ticks_lower(f)
    early, late = ticks.where("run_id = 'run-0'"), ticks.where("run_id <> 'run-0'")
    _days(early, root, BRONZE_PARTITIONS_OLD)
    for batch, key in ((late, "late"), (early, "early"), (late, "late")):
        atomic.upsert_atomic(f.spark, batch, root, "perp_trades", key)
    return lake.scan_lake(f.spark, root, "perp_trades").select(*_TICK)


@query(
    "chunk_flush_manifests",
    """SELECT exchange, instrument_type, symbol, date, rows_out, min_timestamp, max_timestamp FROM (
      SELECT exchange, instrument_type, symbol, strftime(open_time, '%Y-%m-%d') AS date, count(DISTINCT trade_id) AS rows_out,
        strftime(min(open_time), '%Y-%m-%dT%H:%M:%SZ') AS min_timestamp, strftime(max(open_time), '%Y-%m-%dT%H:%M:%SZ') AS max_timestamp
      FROM ticks_lower GROUP BY 1, 2, 3, 4)""",
    "ticks_lower",
)
def chunk_flush_manifests(f):
    """Manifest rows that a streaming load of all ticks in one batch leaves."""
    base = scratch_dir(f.spark, "flush")
    columns = [F.col(c.name).cast(c.dataType) for c in BRONZE_SCHEMAS["perp_trades"]]
    ticks_lower(f).select(*columns).write.parquet(f"{base}/landing")
    flush_stream(f.spark, f"{base}/landing", f"{base}/lake", "perp_trades", f"{base}/checkpoint", files_per_batch=10_000)
    shape = "exchange string, instrument_type string, symbol string, date string, rows_out bigint, min_timestamp string, max_timestamp string"
    return manifests.read_manifests(f.spark, f"{base}/lake/_manifests", shape)


_BAR_ROUND = ", ".join(f"round({c}, 6) AS {c}" for c in BAR_SUMS)


@query(
    "silver_refresh",
    f"SELECT * REPLACE ({_BAR_ROUND}), (SELECT count(DISTINCT (lower(exchange), symbol, strftime(open_time, '%Y-%m'))) FROM ticks_lower WHERE run_id <> 'run-0') AS refreshed FROM ({S.bars_sql('t_obs', 'timestamp_m1', "date_trunc('minute', trade_time)")})",
    "t_obs", "ticks_lower",
)
def silver_refresh(f):
    """Bars of a bronze lake that grew by two commits, each followed by a refresh; and how many months the second rebuilt."""
    bronze_root, silver_root = scratch_dir(f.spark, "bronze"), scratch_dir(f.spark, "silver")
    ticks = ticks_lower(f)
    for batch in (ticks.where("run_id = 'run-0'"), ticks.where("run_id <> 'run-0'")):
        atomic.upsert_atomic(f.spark, batch, bronze_root, "perp_trades")
        again = refresh_silver(f.spark, bronze_root, silver_root, "perp_trades", _LANDED)
    bars = lake.read_silver(f.spark, silver_root, "perp_trades_1m_feature", "1m").drop("year", "month")
    return rounded(bars.withColumn("refreshed", F.lit(again.count())), 6, *BAR_SUMS)


def _sunk(f, dataset: str, rows, corrected):
    """Two sink calls of one dataset, the second correcting the first, read back."""
    root = scratch_dir(f.spark, "sink")
    lake.sink_bronze(f.spark, rows, root, dataset, "20240201T000000000000Z", "2024-02-01")
    lake.sink_bronze(f.spark, corrected, root, dataset, "20240202T000000000000Z", "2024-02-02")
    return lake.scan_lake(f.spark, root, dataset).drop("year", "month", "date")


_STAMP = "TIMESTAMP '2024-02-02' AS ingested_at, '20240202T000000000000Z' AS run_id, 'v1' AS schema_version"


@query(
    "sink_bronze_ohlcv",
    f"""SELECT {_cols([c for c in _CANDLE if c not in ('ingested_at', 'run_id', 'schema_version')])}, {_STAMP},
      close_price AS origin_close, timeframe AS origin_interval FROM spot_s""",
    "spot_s",
)
def sink_bronze_ohlcv(f):
    rows = silver.ohlcv_clean(f.minute_candles("spot"))
    sunk = _sunk(f, "spot", rows.withColumn("close_price", F.col("close_price") - 1), rows)
    return sunk.select(
        *_CANDLE, F.col("origin_payload.close_price").alias("origin_close"), F.col("origin_payload.interval").alias("origin_interval")
    )


@query(
    "sink_bronze_oi",
    f"""SELECT 'oi' AS dataset_type, exchange, symbol, instrument_type, timestamp AS event_time, source_endpoint,
      timestamp AS open_time, close_time, timeframe, open_interest, 0.0::DOUBLE AS open_interest_value, {_STAMP} FROM oi_one""",
    "oi_one",
)
def sink_bronze_oi(f):
    rows = _oi_one(f)
    return _sunk(f, "oi", rows.withColumn("open_interest", F.lit(1.0)), rows)


S.CTES["oi_one"] = (
    ["oi_typed"],
    S._newest("oi_typed", "exchange, symbol, timestamp", "ingested_at DESC, run_id DESC", f"NOT {S.OI_BAD}"),
)


def _oi_one(f):
    from tidelake.operators import quality
    from tidelake.operators.dedup import keep_latest

    valid = quality.keep_valid(silver.type_oi(f.oi()), {"invalid": quality.oi_invalid()})
    return keep_latest(valid, ["exchange", "symbol", "timestamp"], ["ingested_at", "run_id"])


S.CTES["f_one"] = (
    ["f_perp"],
    S._newest("f_perp", "exchange, symbol, funding_time", "ingested_at DESC, run_id DESC", f"NOT {S.FUNDING_NULL} AND NOT {S.FUNDING_BAD}"),
)


def _funding_one(f):
    from tidelake.operators import quality
    from tidelake.operators.dedup import keep_latest

    perp = silver.type_funding(f.funding()).where("instrument_type = 'perp'")
    valid = quality.keep_valid(perp, {"null": quality.funding_null(), "invalid": quality.funding_invalid()})
    return keep_latest(valid, ["exchange", "symbol", "funding_time"], ["ingested_at", "run_id"])


@query(
    "sink_bronze_funding",
    f"""SELECT 'funding' AS dataset_type, exchange, symbol, instrument_type, funding_time AS event_time, source_endpoint,
      funding_time AS open_time, close_time, timeframe, funding_rate, index_price, mark_price, {_STAMP} FROM f_one""",
    "f_one",
)
def sink_bronze_funding(f):
    rows = _funding_one(f)
    return _sunk(f, "funding", rows.withColumn("funding_rate", F.lit(0.0)), rows)


@query(
    "sink_bronze_trades",
    f"""SELECT 'option_trades' AS dataset_type, exchange, symbol, instrument_type, open_time AS event_time, source_endpoint,
      open_time, close_time, timeframe, trade_id, price, quantity, side, is_maker, instrument_name,
      CASE WHEN len(p) >= 4 THEN p[2] ELSE '' END AS expiry, CASE WHEN len(p) >= 4 THEN coalesce(TRY_CAST(p[3] AS DOUBLE), 0) ELSE 0 END AS strike,
      CASE WHEN len(p) < 4 THEN 'unknown' WHEN upper(p[4]) = 'C' THEN 'call' WHEN upper(p[4]) = 'P' THEN 'put' ELSE 'unknown' END AS option_type,
      {_STAMP} FROM (SELECT *, string_split(instrument_name, '-') AS p FROM o_obs)""",
    "o_obs",
)
def sink_bronze_trades(f):
    from tidelake.operators import quality
    from tidelake.operators.dedup import keep_latest
    from tidelake.schemas import TRADE_KEY

    valid = quality.keep_valid(silver.type_trades(f.option_ticks()), {"invalid": quality.trade_invalid()})
    rows = keep_latest(valid, TRADE_KEY, ["ingested_at", "run_id"])
    sunk = _sunk(f, "option_trades", rows.withColumn("price", F.lit(1.0)), rows)
    return sunk


@query(
    "stamp_audit",
    f"""SELECT {_cols([c for c in _CANDLE if c not in ('ingested_at', 'run_id', 'schema_version')])},
      ingested_at, '20240201T000000000000Z' AS run_id, 'v1' AS schema_version, symbol AS origin_symbol FROM spot1""",
    "spot1",
)
def stamp_audit(f):
    rows = lake.stamp_audit(f.minute_candles("spot"), "spot", "20240201T000000000000Z", F.col("ingested_at"))
    return rows.select(*_CANDLE, F.col("origin_payload.symbol").alias("origin_symbol"))


# ---- readers --------------------------------------------------------------------------------------

S.CTES["spot_last"] = (
    ["spot1"],
    S._newest("spot1", "exchange, symbol, open_time", "ingested_at DESC, run_id DESC"),
)


@query(
    "load_typed_candles",
    """SELECT exchange, instrument_type, symbol, timeframe, open_time, close_time, coalesce(open_price, 0) AS open_price,
      high_price, low_price, close_price, volume, quote_volume, trade_count FROM spot_last""",
    "spot_last",
)
def load_typed_candles(f):
    return lake.load_typed(lake.scan_lake(f.spark, bronze_lake(f, "spot"), "spot", old_columns=True), "candles")


@query(
    "load_typed_funding",
    """SELECT exchange, instrument_type, symbol, timeframe, open_time, close_time, coalesce(funding_rate, 0) AS funding_rate,
      index_price, mark_price FROM (""" + S._newest(
        "funding", "exchange, instrument_type, symbol, timeframe, open_time", "ingested_at DESC, run_id DESC") + ")",
    "funding",
)
def load_typed_funding(f):
    return lake.load_typed(lake.scan_lake(f.spark, bronze_lake(f, "funding"), "funding"), "funding")


@query(
    "load_typed_oi",
    """SELECT exchange, instrument_type, symbol, timeframe, open_time, close_time, coalesce(open_interest, 0) AS open_interest,
      open_interest_value FROM (""" + S._newest(
        "oi_typed", "exchange, instrument_type, symbol, timeframe, open_time", "ingested_at DESC, run_id DESC", "length(symbol) > 0") + ")",
    "oi_typed",
)
def load_typed_oi(f):
    return lake.load_typed(lake.scan_lake(f.spark, bronze_lake(f, "oi"), "oi"), "oi")


S.CTES["oi_last"] = (
    ["oi_typed"],
    S._newest(
        "oi_typed", "exchange, instrument_type, symbol, timeframe, open_time", "ingested_at DESC, run_id DESC",
        "length(symbol) > 0 AND open_time >= TIMESTAMP '2024-01-05' AND open_time <= TIMESTAMP '2024-01-20'",
    ),
)
_SHORT = ", ".join(f"c.{c}_price AS {c}" for c in ("open", "high", "low", "close"))


@query(
    "load_combined",
    f"""SELECT exchange, instrument_type, symbol, timeframe, open_time, c.close_time, {_SHORT}, volume, quote_volume, trade_count,
      c.dataset_type, c.run_id, c.source_endpoint, o.open_interest, o.open_interest_value
    FROM (SELECT * FROM spot1 UNION ALL SELECT * FROM perp1) c
    LEFT JOIN oi_last o USING (exchange, instrument_type, symbol, timeframe, open_time)
    WHERE symbol IN ('BTC_USDC', 'BTC-PERPETUAL', 'ETH-PERPETUAL')
      AND open_time >= TIMESTAMP '2024-01-05' AND open_time <= TIMESTAMP '2024-01-20'""",
    "spot1", "perp1", "oi_last",
)
def load_combined(f):
    return combined.load_combined(
        f.spark,
        bronze_lake(f, "spot", "perp", "oi"),
        include_open_interest=True,
        exchanges=["DERIBIT"],
        symbols=["btc_usdc", "BTC-PERPETUAL", "eth-perpetual"],
        start="2024-01-05",
        end="2024-01-20",
    )


@query(
    "write_stats_csv",
    " UNION ALL ".join(
        f"""SELECT '{v}' AS "Variable", round(avg({v}_), 6) AS "Mean", round(stddev_samp({v}_), 6) AS "Std", min({v}_) AS "Min", max({v}_) AS "Max"
        FROM (SELECT {'volume' if v == 'volume' else v + '_price'} AS {v}_ FROM c_clean)"""
        for v in combined.STATS_VARIABLES
    ),
    "c_clean",
)
def write_stats_csv(f):
    stats = profile.descriptive_stats(combined.rename_ohlc(silver.ohlcv_clean(f.candles())), combined.STATS_VARIABLES)
    path = scratch_dir(f.spark, "stats")
    lake.write_stats_csv(stats, path)
    shape = "Variable string, Mean double, Std double, Min double, Max double"
    return rounded(f.spark.read.schema(shape).option("header", True).csv(path), 6, "Mean", "Std")


@query(
    "write_gold",
    """SELECT 'gold.market.core.m1' AS dataset_id, 'v1.0.0' AS feature_set_version, exchange, symbol, timestamp_m1,
      spot_close_price, perp_close_price, perp_volume FROM gold_market_core_m1""",
    "gold_market_core_m1",
)
def write_gold(f):
    root = scratch_dir(f.spark, "gold")
    merged = gold.gold_frame({n: f.silver(n) for n in ("spot", "perp")}, "gold.market.core.m1")
    lake.write_gold(merged, root, "gold.market.core.m1", "v1.0.0")
    columns = ["dataset_id", "feature_set_version", "exchange", "symbol", "timestamp_m1"]
    return f.spark.read.parquet(root).select(*columns, "spot_close_price", "perp_close_price", "perp_volume")


@query("latest_artifact", "SELECT * FROM l2", "l2")
def latest_artifact(f):
    root = scratch_dir(f.spark, "l2")
    for version, shift in (("v1", 0.5), ("v2", 0.0)):
        rows = f.l2().withColumn("coverage_ratio", F.col("coverage_ratio") + shift)
        named = rows.withColumns({"version": F.lit(version), "build_id": F.lit("b")})
        named.write.mode("append").partitionBy("exchange", "symbol", "version", "build_id").parquet(root)
    rows = lake.read_latest_artifacts(f.spark, root)
    return rows.select("ts_minute", "exchange", "symbol", "snapshot_count", "coverage_ratio", "first_snapshot_ts", "last_snapshot_ts", "spread")


# ---- manifests ------------------------------------------------------------------------------------

_LISTED = "[" + ", ".join(f"'{f.name}'" for f in BRONZE_SCHEMAS["spot"]) + "]"
S.CTES["bronze_manifest"] = (
    ["spot1"],
    f"""SELECT *, {_LISTED} AS columns, substring(sha256(to_json({{'columns': {_LISTED}, 'max_timestamp': max_timestamp,
      'min_timestamp': min_timestamp, 'rows_out': rows_out}})::VARCHAR), 1, 12) AS source_data_hash
    FROM (SELECT 'spot_1m' AS dataset, 'spot' AS dataset_type, exchange, instrument_type, symbol, timeframe,
      strftime(open_time, '%Y-%m-%d') AS date, count(*) AS rows_out,
      strftime(min(open_time), '%Y-%m-%dT%H:%M:%SZ') AS min_timestamp,
      strftime(max(open_time), '%Y-%m-%dT%H:%M:%SZ') AS max_timestamp FROM spot1 GROUP BY ALL)""",
)


@query("manifest_bronze", "SELECT * FROM bronze_manifest", "bronze_manifest")
def manifest_bronze(f):
    rows = manifests.manifest_bronze(lake.scan_lake(f.spark, bronze_lake(f, "spot"), "spot"), "spot")
    return rows.drop("value_checksum", "feature_metadata")


def _fact_sql(field) -> str:
    c, kind = field.name, field.dataType.simpleString()
    numeric = kind in ("double", "bigint")
    finite = f"CASE WHEN isnan({c}::DOUBLE) THEN NULL ELSE {c} END"
    stats = {"mean": f"avg({finite})", "std": f"stddev_samp({finite})", "min": f"min({c})::DOUBLE", "max": f"max({c})::DOUBLE"}
    nan = {"mean": f"bool_or(isnan({c}::DOUBLE))", "std": f"bool_or(isnan({c}::DOUBLE))", "min": "false", "max": "false"}
    cells = [f"CASE WHEN {nan[n]} THEN 'NaN'::DOUBLE ELSE round({x}, 6) END AS {n}" if numeric else f"NULL::DOUBLE AS {n}" for n, x in stats.items()]
    seen = f"CASE WHEN {c} IS NOT NULL THEN open_time END"
    return f"""SELECT symbol, strftime(open_time, '%Y-%m-%d') AS date, '{c}' AS column_name, '{kind}' AS dtype,
      count(*) - count({c}) AS null_count, count({c}) AS non_null_count, strftime(min({seen}), '%Y-%m-%dT%H:%M:%SZ') AS min_timestamp,
      strftime(max({seen}), '%Y-%m-%dT%H:%M:%SZ') AS max_timestamp, {", ".join(cells)} FROM spot1 GROUP BY 1, 2"""


@query("manifest_feature_metadata", " UNION ALL ".join(_fact_sql(c) for c in BRONZE_SCHEMAS["spot"] if c.name != "origin_payload"), "spot1")
def manifest_feature_metadata(f):
    """The facts per column that bronze manifests carry, as rows."""
    rows = manifests.manifest_bronze(lake.scan_lake(f.spark, bronze_lake(f, "spot"), "spot"), "spot")
    facts = "dtype string, null_count bigint, non_null_count bigint, min_timestamp string, max_timestamp string, mean double, std double, min double, max double"
    parsed = F.from_json("feature_metadata", f"map<string, struct<{facts.replace(' ', ':').replace(',:', ',')}>>")
    told = rows.select("symbol", "date", F.explode(parsed).alias("column_name", "fact")).select("symbol", "date", "column_name", "fact.*")
    return rounded(told.where("column_name <> 'origin_payload'"), 6, "mean", "std", "min", "max")


def _exact_sql(field) -> str:
    """The texts of :func:`tidelake.functions.hashing.exact_text`, stated in SQL."""
    c, kind = field.name, field.dataType.simpleString()
    if kind == "double":
        high, rest = f"floor({c} / 1125899906842624.0::DOUBLE)", f"({c} - floor({c} / 1125899906842624.0::DOUBLE) * 1125899906842624.0::DOUBLE)"
        parts = [high, f"floor({rest})", f"floor(({rest} - floor({rest})) * 1152921504606846976.0::DOUBLE)"]
        whole = " || ',' || ".join(f"({x})::BIGINT::VARCHAR" for x in parts)
        text = f"CASE WHEN isnan({c}) THEN 'nan' WHEN isinf({c}) THEN CASE WHEN {c} > 0 THEN 'inf' ELSE '-inf' END ELSE {whole} END"
    elif kind == "timestamp":
        text = f"epoch_us({c})::VARCHAR"
    elif kind == "string":
        text = f"length({c})::VARCHAR || ':' || {c}"
    else:
        text = f"{c}::VARCHAR"
    return f"CASE WHEN {c} IS NULL THEN 'n' ELSE {text} END"


_ROW_SQL = " || '|' || ".join(_exact_sql(field) for field in BRONZE_SCHEMAS["perp"] if field.name != "origin_payload")


@query(
    "manifest_bronze_checksum",
    f"""SELECT symbol, strftime(open_time, '%Y-%m-%d') AS date, count(*) AS rows_out,
      sum(('0x' || substr(sha256({_ROW_SQL}), 1, 15))::BIGINT)::VARCHAR AS value_checksum FROM perp1 GROUP BY 1, 2""",
    "perp1",
)
def manifest_bronze_checksum(f):
    rows = manifests.manifest_bronze(lake.scan_lake(f.spark, bronze_lake(f, "perp"), "perp"), "perp")
    return rows.select("symbol", "date", "rows_out", "value_checksum")


@query(
    "missing_manifests",
    "SELECT dataset_type, exchange, instrument_type, symbol, timeframe, date FROM bronze_manifest WHERE date >= '2024-01-15'",
    "bronze_manifest",
)
def missing_manifests(f):
    stored = lake.scan_lake(f.spark, bronze_lake(f, "spot"), "spot")
    root = scratch_dir(f.spark, "manifests")
    manifests.write_manifests(manifests.manifest_bronze(stored.where("date < '2024-01-15'"), "spot"), root)
    shape = "dataset_type string, exchange string, instrument_type string, symbol string, timeframe string, date string"
    days = lake.list_partitions(f.spark, bronze_lake(f, "spot"), "spot")
    return manifests.missing_manifests(days, manifests.read_manifests(f.spark, root, shape))


_BAR_COLUMNS = SILVER_COLUMNS["trades_1m_feature"]
_BAR_LIST = "[" + ", ".join(f"'{c}'" for c in _BAR_COLUMNS) + "]"


@query(
    "manifest_silver",
    f"""SELECT 'perp_trades_1m_feature' AS dataset, exchange, symbol, strftime(timestamp_m1, '%Y-%m') AS month,
      '2024-02-01T00:00:00Z' AS build_date_utc, substring(sha256('{"|".join(_BAR_COLUMNS)}'), 1, 12) AS column_hash,
      count(*) AS rows_out, {_BAR_LIST} AS columns,
      to_json({{'perp_trades_1m_feature': {{'columns': {_BAR_LIST}, 'rows': count(*), 'source_symbols': [symbol]}}}})::VARCHAR AS source_silver_datasets,
      strftime(min(timestamp_m1), '%Y-%m-%dT%H:%M:%SZ') AS min_timestamp,
      strftime(max(timestamp_m1), '%Y-%m-%dT%H:%M:%SZ') AS max_timestamp FROM t_bars GROUP BY 2, 3, 4""",
    "t_bars",
)
def manifest_silver(f):
    clock = F.lit("2024-02-01").cast("timestamp")
    bars = f.silver("perp_trades_1m_feature")
    return manifests.manifest_silver(bars, "perp_trades_1m_feature", "timestamp_m1", clock).drop("feature_metadata")


_SILVER_FACT_TYPES = {c: "string" for c in ("exchange", "symbol", "instrument_type")} | {"timestamp_m1": "timestamp"} | dict.fromkeys(("trade_count", "buy_trade_count", "sell_trade_count"), "bigint")


def _silver_fact_sql(c: str) -> str:
    kind = _SILVER_FACT_TYPES.get(c, "double")
    stats = {"mean": f"avg({c})", "std": f"stddev_samp({c})", "min": f"min({c})::DOUBLE", "max": f"max({c})::DOUBLE"}
    cells = [f"round({x}, 6) AS {n}" if kind in ("double", "bigint") else f"NULL::DOUBLE AS {n}" for n, x in stats.items()]
    seen = f"CASE WHEN {c} IS NOT NULL THEN timestamp_m1 END"
    return f"""SELECT exchange, symbol, strftime(timestamp_m1, '%Y-%m') AS month, '{c}' AS column_name, '{kind}' AS dtype,
      count(*) - count({c}) AS null_count, count({c}) AS non_null_count, strftime(min({seen}), '%Y-%m-%dT%H:%M:%SZ') AS min_timestamp,
      strftime(max({seen}), '%Y-%m-%dT%H:%M:%SZ') AS max_timestamp, {", ".join(cells)} FROM t_bars GROUP BY 1, 2, 3"""


@query("manifest_silver_metadata", " UNION ALL ".join(_silver_fact_sql(c) for c in _BAR_COLUMNS), "t_bars")
def manifest_silver_metadata(f):
    """The facts per column that silver manifests carry, as rows."""
    clock = F.lit("2024-02-01").cast("timestamp")
    rows = manifests.manifest_silver(f.silver("perp_trades_1m_feature"), "perp_trades_1m_feature", "timestamp_m1", clock)
    facts = "dtype string, null_count bigint, non_null_count bigint, min_timestamp string, max_timestamp string, mean double, std double, min double, max double"
    parsed = F.from_json("feature_metadata", f"map<string, struct<{facts.replace(' ', ':').replace(',:', ',')}>>")
    told = rows.select("exchange", "symbol", "month", F.explode(parsed).alias("column_name", "fact")).select("exchange", "symbol", "month", "column_name", "fact.*")
    return rounded(told, 6, "mean", "std", "min", "max")


# ---- landed payloads ------------------------------------------------------------------------------


def _pages(f, payload):
    rows = f.events()
    return rows.select(F.col("event_id").alias("page_no"), F.concat("asset", F.lit("-PERPETUAL")).alias("symbol"), payload.alias("payload"))


def _num(c):
    return c.cast("string")


def kline_pages(f):
    """One chart page per event: its minute twice, the older copy first; some pages are empty or carry no status."""
    tick = F.unix_millis(trunc_minute(F.col("ts")))
    value, k = F.col("value"), F.col("k")

    def pair(older, newer):
        return F.concat(F.lit("["), _num(older), F.lit(","), _num(newer), F.lit("]"))

    arrays = {
        "ticks": pair(tick, tick),
        "open": pair(value - 1, value),
        "high": pair(value + 1, value + 2),
        "low": pair(value - 2, value - 1),
        "close": pair(value, value + 1),
        "volume": pair(k, k),
    }
    body = F.concat_ws(",", *[F.concat(F.lit(f'"{n}":'), a) for n, a in arrays.items()])
    status = F.when(k == 7, F.lit("")).otherwise(F.lit('"status":"ok",'))
    full = F.concat(F.lit('{"result":{'), status, body, F.lit("}}"))
    return _pages(f, F.when(k == 13, F.lit('{"result":{"status":"no_data"}}')).otherwise(full))


@query(
    "normalize_klines",
    """SELECT event_id AS page_no, pos, asset || '-PERPETUAL' AS symbol, t AS open_time, t + INTERVAL 59999 MILLISECOND AS close_time,
      CASE pos WHEN 0 THEN value - 1 ELSE value END AS open_price, CASE pos WHEN 0 THEN value + 1 ELSE value + 2 END AS high_price,
      CASE pos WHEN 0 THEN value - 2 ELSE value - 1 END AS low_price, CASE pos WHEN 0 THEN value ELSE value + 1 END AS close_price,
      k::DOUBLE AS volume, NULL::DOUBLE AS quote_volume, 0::BIGINT AS trade_count
    FROM (SELECT *, date_trunc('minute', ts) AS t, unnest([0, 1]) AS pos FROM ev WHERE k <> 13)""",
    "ev",
)
def normalize_klines(f):
    return landing.normalize_klines(kline_pages(f), 60_000, EXCHANGE).drop("exchange", "timeframe")


S.CTES["kline_rows"] = (["ev"], "SELECT asset || '-PERPETUAL' AS symbol, date_trunc('minute', ts) AS open_time, event_id, value FROM ev WHERE k <> 13")


@query(
    "page_dedup",
    "SELECT symbol, open_time, value AS open_price FROM (" + S._newest(
        "kline_rows", "symbol, open_time", "event_id DESC",
        "open_time BETWEEN TIMESTAMP '2024-01-03' AND TIMESTAMP '2024-01-27'") + ")",
    "kline_rows",
)
def page_dedup(f):
    rows = landing.normalize_klines(kline_pages(f), 60_000, EXCHANGE)
    # fixed values: 2024-01-03 and 2024-01-27 in milliseconds
    kept = landing.page_dedup(rows, landing.PAGE_KEYS["candles"], 1_704_240_000_000, 1_706_313_600_000)
    return kept.select("symbol", "open_time", "open_price")


def funding_pages(f):
    """One funding page per event; the 8-hour rate is absent, null, text or a number, some items have no time."""
    k = F.col("k")
    rate8 = (
        F.when(k < 30, F.lit(""))
        .when(k < 40, F.lit(',"interest_8h":null'))
        .when(k < 50, F.lit(',"interest_8h":"n/a"'))
        .otherwise(F.concat(F.lit(',"interest_8h":'), _num(F.col("value") / 500)))
    )
    item = F.concat(
        F.when(k == 13, F.lit('{"other":1')).otherwise(F.concat(F.lit('{"timestamp":'), _num(F.unix_millis("ts")))),
        F.lit(',"interest_1h":'),
        _num(F.col("value") / 1000),
        rate8,
        F.lit(',"index_price":'),
        _num(F.col("value")),
        F.when(k >= 80, F.lit(',"prev_index_price":null')).otherwise(
            F.concat(F.lit(',"prev_index_price":'), _num(F.col("value") + 1))
        ),
        F.lit("}"),
    )
    return _pages(f, F.concat(F.lit('{"result":['), item, F.lit("]}")))


@query(
    "normalize_funding",
    """SELECT event_id AS page_no, asset || '-PERPETUAL' AS symbol, make_timestamp(epoch_us(ts) // 1000 * 1000) AS open_time,
      CASE WHEN k < 30 THEN value / 1000 WHEN k < 50 THEN 0.0 ELSE value / 500 END AS funding_rate, value AS index_price,
      CASE WHEN k >= 80 THEN value ELSE value + 1 END AS mark_price FROM ev WHERE k <> 13""",
    "ev",
)
def normalize_funding(f):
    rows = landing.normalize_funding(funding_pages(f), EXCHANGE)
    return rows.select("page_no", "symbol", "open_time", "funding_rate", "index_price", "mark_price")


def oi_pages(f):
    item = F.concat(
        F.lit('{"timestamp":'),
        F.when(F.col("k") == 7, F.lit("null")).otherwise(_num(F.unix_millis("ts"))),
        F.lit(',"position":'),
        F.when(F.col("k") == 13, F.lit("null")).otherwise(_num(F.col("value") * 100)),
        F.lit("}"),
    )
    return _pages(f, F.concat(F.lit('{"result":{"settlements":['), item, F.lit('],"continuation":"none"}}')))


@query(
    "normalize_oi",
    """SELECT event_id AS page_no, asset || '-PERPETUAL' AS symbol, make_timestamp(epoch_us(ts) // 1000 * 1000) AS open_time,
      value * 100 AS open_interest, 0.0::DOUBLE AS open_interest_value FROM ev WHERE k NOT IN (7, 13)""",
    "ev",
)
def normalize_oi(f):
    rows = landing.normalize_oi(oi_pages(f), EXCHANGE)
    return rows.select("page_no", "symbol", "open_time", "open_interest", "open_interest_value")


def trade_pages(f):
    """One trade page per event with an older and a newer copy of the trade; prices and markers may be missing."""
    k = F.col("k")
    name = f.option_name()

    def item(price):
        return F.concat(
            F.lit('{"timestamp":'),
            _num(F.unix_millis("ts")),
            F.lit(',"trade_id":"'),
            _num(F.col("event_id")),
            F.lit('"'),
            F.when(k == 13, F.lit("")).otherwise(F.concat(F.lit(',"price":'), _num(price))),
            F.lit(',"amount":'),
            _num(k),
            F.when(F.col("event_type") == "purchase", F.lit(',"direction":"BUY"'))
            .when(F.col("event_type") == "click", F.lit(',"direction":"sell"'))
            .otherwise(F.lit("")),
            F.when(F.col("event_type") == "error", F.lit(',"liquidation":"M"')).otherwise(F.lit("")),
            F.lit(',"instrument_name":"'),
            name,
            F.lit('"}'),
        )

    body = F.concat_ws(",", item(F.col("value") - 1), item(F.col("value")))
    return _pages(f, F.concat(F.lit('{"result":{"trades":['), body, F.lit('],"has_more":false}}')))


_TRADE_SQL = """event_id AS page_no, pos, make_timestamp(epoch_us(ts) // 1000 * 1000) AS open_time, event_id::VARCHAR AS trade_id,
      CASE WHEN k = 13 THEN 0.0 WHEN pos = 0 THEN value - 1 ELSE value END AS price, k::DOUBLE AS quantity,
      CASE event_type WHEN 'purchase' THEN 'buy' WHEN 'click' THEN 'sell' ELSE 'unknown' END AS side,
      event_type = 'error' AS is_maker"""
_TRADE_FIELDS = ["page_no", "pos", "open_time", "trade_id", "price", "quantity", "side", "is_maker"]


@query(
    "normalize_trades",
    f"SELECT asset || '-PERPETUAL' AS symbol, {_TRADE_SQL} FROM (SELECT *, unnest([0, 1]) AS pos FROM ev)",
    "ev",
)
def normalize_trades(f):
    return landing.normalize_trades(trade_pages(f), EXCHANGE).select("symbol", *_TRADE_FIELDS)


S.CTES["option_names"] = (["options"], "SELECT DISTINCT trade_id, instrument_name FROM options")


@query(
    "normalize_option_trades",
    f"""SELECT asset AS symbol, {_TRADE_SQL}, instrument_name,
      CASE WHEN len(p) >= 4 THEN p[2] ELSE '' END AS expiry, CASE WHEN len(p) >= 4 THEN coalesce(TRY_CAST(p[3] AS DOUBLE), 0) ELSE 0 END AS strike,
      CASE WHEN len(p) < 4 THEN 'unknown' WHEN upper(p[4]) = 'C' THEN 'call' WHEN upper(p[4]) = 'P' THEN 'put' ELSE 'unknown' END AS option_type
    FROM (SELECT ev.*, n.instrument_name, string_split(n.instrument_name, '-') AS p, unnest([0, 1]) AS pos
      FROM ev JOIN option_names n ON n.trade_id = ev.event_id::VARCHAR)""",
    "ev", "option_names",
)
def normalize_option_trades(f):
    rows = landing.normalize_option_trades(trade_pages(f), EXCHANGE)
    return rows.select("symbol", *_TRADE_FIELDS, "instrument_name", "expiry", "strike", "option_type")


@query(
    "sort_series",
    "SELECT symbol, open_time, close_price FROM c_clean ORDER BY symbol, open_time",
    "c_clean",
)
def sort_series(f):
    return silver.ohlcv_clean(f.candles()).select("symbol", "open_time", "close_price").orderBy("symbol", "open_time")


# ---- newest rows of artifacts and manifests -------------------------------------------------------


@query(
    "latest_manifest",
    """SELECT dataset_id, exchange, symbol, built_at, source_data_hash FROM (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY built_at DESC) AS rn FROM history)
    WHERE rn = 1""",
    "history",
)
def latest_manifest(f):
    from tidelake.catalog.governance import history

    root = scratch_dir(f.spark, "history")
    manifests.write_manifests(history(f), root)
    # lines that are not JSON lie next to the good ones
    broken = f.events().select(F.concat(F.lit('{"dataset_id": "x", "symbol": '), "event_type").alias("value"))
    broken.distinct().write.mode("append").text(root)
    stored = manifests.read_manifests(f.spark, root, gold.MANIFEST_SCHEMA)
    return governance.latest_manifest(stored).select("dataset_id", "exchange", "symbol", "built_at", "source_data_hash")


# ---- from pages to gold ---------------------------------------------------------------------------


def landed_lake(f) -> tuple[str, str]:
    """Bronze and silver candles of all chart pages of both markets; perp pages are delivered twice."""
    bronze_root, silver_root = scratch_dir(f.spark, "bronze"), scratch_dir(f.spark, "silver")
    perp = kline_pages(f)
    spot = perp.withColumn("symbol", F.regexp_replace("symbol", "-PERPETUAL", "_USDC"))
    ingest_pages(f.spark, spot, bronze_root, "spot", "run-0", _LANDED)
    for run, at in (("run-0", _LANDED), ("run-1", _LANDED_AGAIN)):
        ingest_pages(f.spark, perp, bronze_root, "perp", run, at)
    for market in ("spot", "perp"):
        silver.build_silver(f.spark, bronze_root, silver_root, market, _LANDED_AGAIN)
    return bronze_root, silver_root


_LANDED, _LANDED_AGAIN = "2024-03-01 00:00:00", "2024-03-02 00:00:00"
for _market, _suffix in (("spot", "_USDC"), ("perp", "-PERPETUAL")):
    S.CTES[f"landed_{_market}"] = (
        ["ev"],
        f"""SELECT date_trunc('minute', ts) AS timestamp_m1, 'deribit' AS exchange, asset AS symbol,
          arg_max(value, event_id) AS {_market}_open_price, arg_max(value, event_id) + 2 AS {_market}_high_price,
          arg_max(value, event_id) - 1 AS {_market}_low_price, arg_max(value, event_id) + 1 AS {_market}_close_price,
          arg_max(k, event_id)::DOUBLE AS {_market}_volume FROM ev WHERE k <> 13 GROUP BY 1, 2, 3""",
    )
S.gold_cte("landed_core", ["landed_spot", "landed_perp"])


@query(
    "pipeline_core",
    """SELECT *, 'v1.0.0' AS feature_set_version, count(*) OVER (PARTITION BY exchange, symbol) AS manifest_rows FROM landed_core""",
    "landed_core",
)
def pipeline_core(f):
    """Chart pages to bronze, silver and gold with all manifests; gold rows as stored, with the manifest's row count."""
    _, silver_root = landed_lake(f)
    gold_root = scratch_dir(f.spark, "gold")
    gold.build_gold(f.spark, silver_root, gold_root, "gold.market.core.m1", _LANDED_AGAIN)
    facts = manifests.read_manifests(f.spark, f"{gold_root}/_manifests", "exchange string, symbol string, rows_out bigint")
    stored = f.spark.read.parquet(f"{gold_root}/dataset_id=gold.market.core.m1")
    return stored.join(facts.withColumnRenamed("rows_out", "manifest_rows"), ["exchange", "symbol"])


# The other feeds the same way: trade, funding and open-interest pages of all events, delivered twice.
_MS = "make_timestamp(epoch_us(ts) // 1000 * 1000)"
_LANDED_KEY = "'deribit' AS exchange, asset || '-PERPETUAL' AS symbol"
S.CTES["landed_trades"] = (
    ["ev"],
    f"""SELECT {_LANDED_KEY}, 'perp' AS instrument_type, {_MS} AS trade_time, event_id::VARCHAR AS trade_id, value AS price, k::DOUBLE AS quantity,
      CASE event_type WHEN 'purchase' THEN 'buy' WHEN 'click' THEN 'sell' ELSE 'unknown' END AS side FROM ev WHERE k NOT IN (0, 13)""",
)
S.CTES["landed_bars"] = (["landed_trades"], S.bars_sql("landed_trades", "timestamp_m1", "date_trunc('minute', trade_time)"))
S.CTES["landed_g_trades"] = (["landed_bars"], S.CTES["g_trades"][1].replace("t_bars", "landed_bars"))
S.gold_cte("landed_trades_gold", ["landed_g_trades"])
S.CTES["landed_funding"] = (
    ["ev"],
    f"""SELECT {_LANDED_KEY}, {_MS} AS funding_time, TIMESTAMP '{_LANDED_AGAIN}' AS ingested_at_max,
      CASE WHEN k < 30 THEN value / 1000 WHEN k < 50 THEN 0.0 ELSE value / 500 END AS funding_rate FROM ev WHERE k <> 13 AND (k < 50 OR value <= 500)""",
)
S.CTES["landed_oi"] = (
    ["ev"],
    f"SELECT {_LANDED_KEY}, {_MS} AS timestamp, TIMESTAMP '{_LANDED_AGAIN}' AS ingested_at, value * 100 AS open_interest FROM ev WHERE k NOT IN (7, 13)",
)


def _landed_silver(f, dataset: str, pages) -> str:
    bronze_root, silver_root = scratch_dir(f.spark, "bronze"), scratch_dir(f.spark, "silver")
    for run, at in (("run-0", _LANDED), ("run-1", _LANDED_AGAIN)):
        ingest_pages(f.spark, pages, bronze_root, dataset, run, at)
    silver.build_silver(f.spark, bronze_root, silver_root, dataset, _LANDED_AGAIN, cutoff=FAR_CUTOFF)
    return silver_root


@query("pipeline_trades", f"SELECT * REPLACE ({', '.join(f'round({c}, 6) AS {c}' for c in TRADE_SUMS[:5])}) FROM landed_trades_gold", "landed_trades_gold")
def pipeline_trades(f):
    """Trade pages to bronze, silver bars and the gold table of trades, as stored."""
    silver_root, gold_root = _landed_silver(f, "perp_trades", trade_pages(f)), scratch_dir(f.spark, "gold")
    gold.build_gold(f.spark, silver_root, gold_root, "gold.market.perp_trades.m1", _LANDED_AGAIN)
    stored = f.spark.read.parquet(f"{gold_root}/dataset_id=gold.market.perp_trades.m1").drop("feature_set_version")
    return rounded(stored, 6, *TRADE_SUMS[:5])


@query("pipeline_funding", S.funding_feature_sql("landed_funding", FAR_CUTOFF), "landed_funding")
def pipeline_funding(f):
    """Funding pages to bronze and the minute table of silver, as stored."""
    root = _landed_silver(f, "funding", funding_pages(f))
    return lake.read_silver(f.spark, root, "funding_1m_feature", "1m").drop("year", "month")


@query("pipeline_oi", S.oi_feature_sql("landed_oi", FAR_CUTOFF), "landed_oi")
def pipeline_oi(f):
    """Open-interest pages to bronze and the minute table of silver, as stored."""
    root = _landed_silver(f, "oi", oi_pages(f))
    return lake.read_silver(f.spark, root, "oi_1m_feature", "1m").drop("year", "month")


_WITHOUT_OPTIONS = ["spot", "perp", "oi_1m_feature", "funding_1m_feature", "perp_trades_1m_feature"]
_GAPS = {"gold.market.option_trades.m1": "option_trades_1m_feature", "gold.market.full.m1": "option_trades_1m_feature", "gold.hybrid.full_l2.m1": "gold_l2_m1,option_trades_1m_feature"}


def _built_sql(dataset_id: str) -> str:
    if dataset_id in _GAPS:
        return f"SELECT '{dataset_id}' AS dataset_id, 'deribit' AS exchange, symbol, 'skipped' AS status, '{_GAPS[dataset_id]}' AS missing_inputs, NULL::VARCHAR AS dataset_version, NULL::BIGINT AS rows_out FROM g_spot GROUP BY 3"
    table = dataset_id.replace(".", "_")
    return f"SELECT '{dataset_id}', exchange, symbol, 'built', NULL, 'v1.0.0', count(*) FROM {table} GROUP BY 2, 3"


_BUILDABLE = ["gold.market.perp_trades.m1", "gold.market.core.m1", "gold.market.core_funding.m1"]


@query(
    "gold_build_all",
    " UNION ALL ".join(_built_sql(d) for d in [*_GAPS, *_BUILDABLE]),
    "g_spot", *[d.replace(".", "_") for d in _BUILDABLE],
)
def gold_build_all(f):
    """All gold datasets from a silver lake without option trades; what lacks inputs is skipped and says which."""
    silver_root = scratch_dir(f.spark, "silver")
    times = {"spot": "open_time", "perp": "open_time", "funding_1m_feature": "timestamp"}
    for name in _WITHOUT_OPTIONS:
        lake.write_silver(f.silver(name), silver_root, name, "1m", times.get(name, "timestamp_m1"))
    return gold.build_all_gold(f.spark, silver_root, scratch_dir(f.spark, "gold"), _LANDED)


# ---- gold with order-book rows --------------------------------------------------------------------

_HYBRID = "gold.hybrid.full_l2.m1"


@query(
    "gold_hybrid_build",
    f"""SELECT h.* REPLACE ({", ".join(f"round({c}, 6) AS {c}" for c in TRADE_SUMS)}), 'lenient' AS l2_validation_mode, found AS l2_invalid_rows_found,
      CASE WHEN found > 0 THEN rows - good ELSE 0 END AS l2_invalid_rows_dropped, count(*) OVER (PARTITION BY exchange, symbol) AS rows_out
    FROM hybrid_lenient h JOIN l2_found ON exchange = e_ AND symbol = s_""",
    "hybrid_lenient",
)
def gold_hybrid_build(f):
    """The build over silver tables and the newest order-book artifacts, as stored, next to what its manifest says.

    A symbol whose order-book rows are all bad has no rows; where that holds for every symbol, nothing is built.
    """
    silver_root, l2_root, gold_root = (scratch_dir(f.spark, n) for n in ("silver", "l2", "gold"))
    raw = {n: f.silver(n) for n in gold.gold_inputs(_HYBRID)} | {L2_INPUT: f.l2()}
    times = {"spot": "open_time", "perp": "open_time", "funding_1m_feature": "timestamp"}
    for name in [*_WITHOUT_OPTIONS, "option_trades_1m_feature"]:
        lake.write_silver(raw[name], silver_root, name, "1m", times.get(name, "timestamp_m1"))
    for build, shift in (("older", 0.5), ("newer", 0.0)):
        rows = f.l2().withColumns({"coverage_ratio": F.col("coverage_ratio") + shift, "version": F.lit("7"), "build_id": F.lit(build)})
        rows.write.mode("append").partitionBy("exchange", "symbol", "version", "build_id").parquet(l2_root)
    facts = gold.build_gold(f.spark, silver_root, gold_root, _HYBRID, _LANDED, l2_root=l2_root, l2_mode="lenient", may_be_empty=True)
    told = facts.select("exchange", "symbol", "l2_validation_mode", "l2_invalid_rows_found", "l2_invalid_rows_dropped", "rows_out")
    stored = gold.read_gold(f.spark, gold_root, _HYBRID, raw).drop("feature_set_version")
    return rounded(stored.join(told, ["exchange", "symbol"]), 6, *TRADE_SUMS)
