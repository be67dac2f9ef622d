"""Reading and writing the partitioned parquet lake."""

from __future__ import annotations

import hashlib
from datetime import date, datetime

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelake.functions.times import at, date_part, month_part, year_part
from tidelake.operators.dedup import keep_latest, pad_columns, union_relaxed
from tidelake.operators.small import join_small, settle
from tidelake.schemas import (
    BRONZE_KEY,
    BRONZE_PARTITIONS,
    BRONZE_PARTITIONS_OLD,
    BRONZE_SCHEMAS,
    GOLD_PARTITIONS,
    OHLCV_KEY,
    OLD_CANDLE_COLUMNS,
    ORIGIN_FIELDS,
    SCHEMA_VERSION,
    SERIES,
    SILVER_PARTITIONS,
    SILVER_SCHEMAS,
    SOURCE_ENDPOINT,
)
from tidelake.session import scratch_dir, scratch_root, spread
from tidelake.sources.commits import DAY, commit_log, live_days, live_paths, scan_versions
from tidelake.sources.paths import choice, list_artifacts, read_if_there

STORED_ORDER = ["ingested_at", "run_id"]
ROWS_PER_FILE = 5_000_000


# ---- partition columns and audit columns ----------------------------------------------------------


def with_partitions(df: DataFrame, time: str = "open_time") -> DataFrame:
    """Add the ``year``, ``month`` and ``date`` partition columns of a time column."""
    t = F.col(time)
    return df.withColumns({"year": year_part(t), "month": month_part(t), "date": date_part(t)})


def parse_partition_path(path: Column) -> Column:
    """Partition values from a file path; null when any of them is missing."""
    names = ["dataset_type", "exchange", "instrument_type", "symbol", "timeframe", "date"]
    found = {n: F.nullif(F.regexp_extract(path, f"(?:^|/){n}=([^/]+)", 1), F.lit("")) for n in names}
    whole = F.lit(True)
    for value in found.values():
        whole = whole & value.isNotNull()
    return F.when(whole, F.struct(*[value.alias(n) for n, value in found.items()]))


def run_id_at(moment: datetime) -> str:
    """Run identifier of a write."""
    return moment.strftime("%Y%m%dT%H%M%S%fZ")


def stamp_audit(rows: DataFrame, dataset_type: str, run_id: str | Column, ingested_at: datetime | str | Column) -> DataFrame:
    """Typed rows to bronze rows: constants, run id, ingest time and (candles) the payload they came from.

    Run id and clock are parameters, so a re-run of the same batch writes the same rows.
    """
    run = run_id if isinstance(run_id, Column) else F.lit(run_id)
    clock = ingested_at if isinstance(ingested_at, Column) else at(ingested_at)
    out = rows.withColumns(
        {
            "schema_version": F.lit(SCHEMA_VERSION),
            "dataset_type": F.lit(dataset_type),
            "source_endpoint": F.lit(SOURCE_ENDPOINT[dataset_type]),
            "run_id": run,
            "ingested_at": clock,
            "event_time": F.col("open_time"),
        }
    )
    if dataset_type in ("spot", "perp"):
        origin = [F.col("timeframe" if f == "interval" else f).alias(f) for f in ORIGIN_FIELDS]
        out = out.withColumn("origin_payload", F.struct(*origin))
    return pad_columns(out, {f.name: f.dataType.simpleString() for f in BRONZE_SCHEMAS[dataset_type]})


# ---- reading --------------------------------------------------------------------------------------


def scan_lake(
    spark: SparkSession,
    root: str,
    dataset_type: str,
    exchange: str | None = None,
    instrument_type: str | None = None,
    symbol: str | None = None,
    timeframe: str | None = None,
    months: str | list[str] | None = None,
    old_columns: bool = False,
) -> DataFrame:
    """Bronze rows of a dataset over both folder layouts (with and without the ``year=`` level) and its committed versions.

    Values given here narrow the listing itself; filters on partition columns of the result prune as usual. The
    fixed schema spares schema inference, and columns a file lacks are null. A day that the commit log names is read from
    its live version alone; what is committed after this call is not seen.
    """
    schema = stored_schema(dataset_type, old_columns)
    narrowed = (exchange, instrument_type, symbol, timeframe, months)
    log = commit_log(spark, root, dataset_type)  # listed before the files, so every version it names is found
    found = scan_layouts(spark, root, dataset_type, schema, *narrowed)
    parts = [rows for rows in found if rows is not None]
    if log is not None:
        live = live_days(log)
        parts = [rows.join(live.select(*DAY), DAY, "left_anti") for rows in parts]
        versions = scan_versions(spark, root, dataset_type, schema, live, *narrowed)
        parts += [] if versions is None else [versions]
    return union_relaxed(*parts) if parts else spark.createDataFrame([], schema)


def stored_schema(dataset_type: str, old_columns: bool = False) -> T.StructType:
    old = OLD_CANDLE_COLUMNS if old_columns else []
    return T.StructType([*BRONZE_SCHEMAS[dataset_type], *old, *[T.StructField(p, T.StringType()) for p in ("year", "month", "date")]])


def scan_layouts(
    spark: SparkSession,
    root: str,
    dataset_type: str,
    schema: T.StructType,
    exchange: str | None = None,
    instrument_type: str | None = None,
    symbol: str | None = None,
    timeframe: str | None = None,
    months: str | list[str] | None = None,
) -> tuple[DataFrame | None, DataFrame | None]:
    """Rows stored with the ``year=`` level and rows stored without it; None for a layout without folders."""
    series = (
        f"{root}/dataset_type={dataset_type}/exchange={choice(exchange)}/instrument_type={choice(instrument_type)}"
        f"/symbol={choice(symbol)}/timeframe={choice(timeframe)}"
    )
    current = read_if_there(spark, root, f"{series}/year=*/month={choice(months)}", schema)
    no_year = T.StructType([f for f in schema if f.name != "year"])
    old = read_if_there(spark, root, f"{series}/month={choice(months)}", no_year)
    return (
        None if current is None else current.select(*schema.names),
        None if old is None else old.withColumn("year", F.substring("month", 1, 4)).select(*schema.names),
    )


def list_partitions(
    spark: SparkSession,
    root: str,
    dataset_type: str,
    exchange: str | None = None,
    instrument_type: str | None = None,
    symbol: str | None = None,
    timeframe: str | None = None,
) -> DataFrame:
    """Day partitions that hold files, in both layouts, from the folder listing, and those of the commit log; no data file is opened."""
    series = (
        f"{root}/dataset_type={dataset_type}/exchange={choice(exchange)}/instrument_type={choice(instrument_type)}"
        f"/symbol={choice(symbol)}/timeframe={choice(timeframe)}"
    )
    found = [list_artifacts(spark, f"{series}/{level}=*") for level in ("year", "month")]
    log = commit_log(spark, root, dataset_type)
    if log is not None:
        for column, value in zip(SERIES, (exchange, instrument_type, symbol, timeframe)):
            log = log if value is None else log.where(F.col(column) == value)
        found.append(live_paths(log, root))
    files = union_relaxed(*[f for f in found if f is not None]) if any(f is not None for f in found) else None
    if files is None:
        files = spark.createDataFrame([], "path string, modificationTime timestamp")
    days = files.select(parse_partition_path(F.col("path")).alias("p")).where("p is not null").select("p.*").distinct()
    return days.withColumns({"month": F.substring("date", 1, 7), "year": F.substring("date", 1, 4)})


def discover_symbols(
    spark: SparkSession, root: str, dataset_type: str, exchange: str, timeframe: str, instrument_type: str | None = None
) -> DataFrame:
    """Symbols that have a timeframe."""
    days = list_partitions(spark, root, dataset_type, exchange, instrument_type, timeframe=timeframe)
    return days.select("symbol").distinct()


def discover_months(
    spark: SparkSession, root: str, dataset_type: str, exchange: str, symbol: str, timeframe: str
) -> DataFrame:
    """Months of a symbol, in order."""
    days = list_partitions(spark, root, dataset_type, exchange, None, symbol, timeframe)
    return days.select("month").distinct().orderBy("month")


def stored_open_times(stored: DataFrame) -> DataFrame:
    """Distinct open times per series."""
    return stored.where(F.col("open_time").isNotNull()).select(*SERIES, "open_time").distinct()


def last_days(spark: SparkSession, root: str, dataset_type: str) -> DataFrame:
    """Rows of each series' last day. Which days these are comes from the listing; files of other dates are not opened.

    The dates, at most as many as the calendar has, become a partition filter; the join keeps each series' own.
    """
    days = settle(list_partitions(spark, root, dataset_type).groupBy(*SERIES).agg(F.max("date").alias("date")), "last-days")
    dates = sorted(r.date for r in days.select("date").distinct().collect())
    stored = scan_lake(spark, root, dataset_type)
    return stored.where(F.col("date").isin(dates)).join(days, DAY, "left_semi")


def latest_open_time(spark: SparkSession, root: str, dataset_type: str) -> DataFrame:
    """Newest open time per series, read from the series' last days."""
    return last_days(spark, root, dataset_type).groupBy(*SERIES).agg(F.max("open_time").alias("open_time"))


# fixed values: typed columns and the number that stands in for a missing one
TYPED_COLUMNS = {
    "candles": {
        "open_price": 0.0, "high_price": 0.0, "low_price": 0.0, "close_price": 0.0, "volume": 0.0,
        "quote_volume": None, "trade_count": 0,
    },
    "oi": {"open_interest": 0.0, "open_interest_value": 0.0},
    "funding": {"funding_rate": 0.0, "index_price": 0.0, "mark_price": 0.0},
}


def load_typed(stored: DataFrame, kind: str) -> DataFrame:
    """Full history of stored series: one row per open time, rows without both times dropped, numbers filled in."""
    have = set(stored.columns)
    values = {}
    for name, default in TYPED_COLUMNS[kind].items():
        sources = [F.col(n) for n in (name, name.removesuffix("_price")) if n in have]
        filled = F.coalesce(*sources, *([] if default is None else [F.lit(default)]))
        values[name] = filled.cast("bigint" if name == "trade_count" else "double")
    rows = stored.where(F.col("open_time").isNotNull() & F.col("close_time").isNotNull())
    return keep_latest(rows, OHLCV_KEY, STORED_ORDER).select(
        *SERIES, "open_time", "close_time", *[c.alias(n) for n, c in values.items()]
    )


# ---- upsert ---------------------------------------------------------------------------------------


def merge_latest(stored: DataFrame, new: DataFrame) -> DataFrame:
    """Stored and new rows with one row per natural key: the newest ingest, a new row on equal terms."""
    both = union_relaxed(stored.withColumn("_new", F.lit(0)), new.withColumn("_new", F.lit(1)))
    key = [c for c in BRONZE_KEY if c in both.columns]
    return keep_latest(both, key, [*STORED_ORDER, "_new"]).drop("_new")


def merge_layouts(current: DataFrame | None, old: DataFrame, new: DataFrame) -> DataFrame:
    """:func:`merge_latest` over days stored in both layouts; ``_old`` says in which one a row is published.

    A key stays in the layout that holds it. A new key goes where its day is stored, with the year level if both hold
    the day. So no row moves, and a plain scan of both layouts meets every key once if it did so before.
    """
    days = [c for c in BRONZE_PARTITIONS if c not in ("dataset_type", "year", "month")]
    only_old = old.select(*days).distinct()
    stored = old.withColumn("_old", F.lit(True))
    if current is not None:
        only_old = only_old.join(current.select(*days).distinct(), days, "left_anti")
        stored = union_relaxed(stored, current.withColumn("_old", F.lit(False)))
    both = union_relaxed(stored.withColumn("_new", F.lit(0)), new.withColumn("_new", F.lit(1)))
    key = [c for c in BRONZE_KEY if c in both.columns]
    same = Window.partitionBy(*key)
    no = F.lit(False)
    placed = both.withColumns({"_in_old": F.coalesce(F.max("_old").over(same), no), "_in_year": F.coalesce(F.max(~F.col("_old")).over(same), no)})
    newest = keep_latest(placed, key, [*STORED_ORDER, "_new"]).drop("_new", "_old")
    newest = join_small(newest, only_old.withColumn("_day_old", F.lit(True)), days)
    to_old = F.col("_in_old") | (~F.col("_in_year") & F.coalesce("_day_old", no))
    homes = F.when(F.col("_in_old") & F.col("_in_year"), F.array(F.lit(True), no)).otherwise(F.array(to_old))
    return newest.withColumn("_old", F.explode(homes)).select(*new.columns, "_old")


def _publish(rows: DataFrame, root: str, pieces: int, partitions: list[str] = BRONZE_PARTITIONS) -> None:
    """Replace the day partitions that ``rows`` hold, in ``pieces`` ranges of equal size.

    Ranges follow partition and time, so small days share a task only when there are more of them than tasks, and a
    day with much of the rows is split over several files.
    """
    (
        rows.repartitionByRange(pieces, *partitions, "open_time")
        .sortWithinPartitions(*partitions, "open_time")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partitions)
        .parquet(root)
    )


def _months_between(lo: date, hi: date) -> list[str]:
    first, last = lo.year * 12 + lo.month - 1, hi.year * 12 + hi.month - 1
    return [f"{m // 12:04d}-{m % 12 + 1:02d}" for m in range(first, last + 1)]


#: What the marker of a stage says; a missing or half-written marker counts as open.
OPEN, FINISHED, PUBLISHED = 0, 1, 2


def _state(spark: SparkSession, stage: str) -> int:
    path = f"{stage}/state"
    found = read_if_there(spark, path, path, T.StructType([T.StructField("id", T.LongType())]))
    said = [] if found is None else found.limit(2).collect()
    return said[0].id if len(said) == 1 else OPEN


def _mark(spark: SparkSession, stage: str, state: int) -> None:
    spark.range(state, state + 1).coalesce(1).write.mode("overwrite").parquet(f"{stage}/state")


def _publish_staged(spark: SparkSession, stage: str, root: str, dataset_type: str, rows_per_file: int) -> DataFrame:
    """Publish the finished copy of a stage, each row in its layout; returns the partitions and their rows."""
    path = f"{stage}/rows"
    staged = read_if_there(spark, path, path, T.StructType([*stored_schema(dataset_type), T.StructField("_old", T.BooleanType())]))
    by_day = staged.groupBy(*BRONZE_PARTITIONS)
    written = settle(by_day.agg(F.count(F.lit(1)).alias("rows"), F.count_if("_old").alias("_in_old")), "upserted")
    size = written.agg(
        F.count_if(F.col("rows") > F.col("_in_old")).alias("days"), F.sum(F.col("rows") - F.col("_in_old")).alias("rows"),
        F.count_if(F.col("_in_old") > 0).alias("old_days"), F.sum("_in_old").alias("old_rows"),
    ).first()
    if size.days:
        _publish(staged.where(~F.col("_old")).drop("_old"), root, max(min(size.days, spread(spark)), -(-size.rows // rows_per_file)))
    if size.old_days:
        old = staged.where("_old").drop("_old", "year")
        _publish(old, root, max(min(size.old_days, spread(spark)), -(-size.old_rows // rows_per_file)), BRONZE_PARTITIONS_OLD)
    _mark(spark, stage, PUBLISHED)
    return written.drop("_in_old")


def upsert_partitions(
    spark: SparkSession, new: DataFrame, root: str, dataset_type: str, stage: str | None = None, rows_per_file: int = ROWS_PER_FILE
) -> DataFrame:
    """Merge bronze rows into the day partitions they belong to; returns the partitions written and their rows.

    Only the touched days are read and rewritten, each in the layout it is stored in; a hot day is split over several
    files. New rows and merged days are written to ``stage``, and the merged days are then published with a dynamic
    partition overwrite. A stage that is used again after its batch died while publishing is published first, from the
    finished copy, so no half-replaced day is ever merged with; then the batch itself runs, and a batch delivered twice
    changes nothing. Without ``stage`` a fresh folder is taken, which cannot be found again. Runs that go on at the same time need
    stages of their own.
    """
    stage = stage or scratch_dir(spark, "upsert")
    if _state(spark, stage) == FINISHED:
        _publish_staged(spark, stage, root, dataset_type, rows_per_file)
    _mark(spark, stage, OPEN)
    dated = with_partitions(new)
    dated.write.mode("overwrite").parquet(f"{stage}/new")
    fresh = spark.read.schema(dated.schema).parquet(f"{stage}/new")
    span = fresh.agg(
        F.min("open_time").cast("date").alias("lo"), F.max("open_time").cast("date").alias("hi"), F.count_if(F.col("open_time").isNull()).alias("timeless")
    ).first()
    if span.timeless:
        raise ValueError(f"{span.timeless} rows without open_time; they belong to no day")
    if span.lo is None:
        return spark.createDataFrame([], dated.schema).groupBy(*BRONZE_PARTITIONS).agg(F.count(F.lit(1)).alias("rows"))
    months = [r.month for r in fresh.select("month").distinct().limit(len(_months_between(span.lo, span.hi))).collect()]
    days = [c for c in BRONZE_PARTITIONS if c not in ("dataset_type", "year", "month")]
    touched = settle(fresh.select(*days).distinct(), "touched")
    # The bounds on the day are partition filters, so files of other days are not opened.
    current, old = [
        None if rows is None else rows.where(F.col("date").between(str(span.lo), str(span.hi))).join(touched, days, "left_semi")
        for rows in scan_layouts(spark, root, dataset_type, stored_schema(dataset_type), months=sorted(months))
    ]
    if old is not None and not old.isEmpty():
        merged = merge_layouts(current, old, fresh)
    else:
        stored = spark.createDataFrame([], fresh.schema) if current is None else current
        merged = merge_latest(stored, fresh).withColumn("_old", F.lit(False))
    merged.write.mode("overwrite").parquet(f"{stage}/rows")
    _mark(spark, stage, FINISHED)
    return _publish_staged(spark, stage, root, dataset_type, rows_per_file)


def batch_stage(spark: SparkSession, root: str, dataset_type: str, run_id: str) -> str:
    """The stage of a run's upsert into a dataset: the same folder whenever the run is started again."""
    name = hashlib.sha256("\n".join([root.rstrip("/"), dataset_type, run_id]).encode()).hexdigest()[:32]
    return f"{scratch_root(spark)}/tidelake/upsert-{name}"


def sink_bronze(
    spark: SparkSession, rows: DataFrame, root: str, dataset_type: str, run_id: str, ingested_at: datetime | str
) -> DataFrame:
    """Stamp typed rows of one dataset and upsert them.

    The stage is named by lake, dataset and run id, so a run that died while publishing is finished by starting it again.
    """
    stage = batch_stage(spark, root, dataset_type, run_id)
    return upsert_partitions(spark, stamp_audit(rows, dataset_type, run_id, ingested_at), root, dataset_type, stage)


def sink_bronze_ohlcv(spark: SparkSession, rows: DataFrame, root: str, market: str, run_id: str, ingested_at: datetime | str) -> DataFrame:
    if market not in ("spot", "perp"):
        raise ValueError(f"unsupported candle market: {market}")
    return sink_bronze(spark, rows, root, market, run_id, ingested_at)


def sink_bronze_oi(spark: SparkSession, rows: DataFrame, root: str, run_id: str, ingested_at: datetime | str) -> DataFrame:
    return sink_bronze(spark, rows, root, "oi", run_id, ingested_at)


def sink_bronze_funding(spark: SparkSession, rows: DataFrame, root: str, run_id: str, ingested_at: datetime | str) -> DataFrame:
    return sink_bronze(spark, rows, root, "funding", run_id, ingested_at)


def sink_bronze_trades(spark: SparkSession, rows: DataFrame, root: str, market: str, run_id: str, ingested_at: datetime | str) -> DataFrame:
    dataset = "option_trades" if market == "option" else "perp_trades"
    return sink_bronze(spark, rows, root, dataset, run_id, ingested_at)


# ---- silver, gold and statistics ------------------------------------------------------------------


def write_silver(df: DataFrame, root: str, dataset_type: str, timeframe: str, time: str) -> None:
    """Monthly files per dataset and symbol; a re-run replaces the months it covers."""
    t = F.col(time)
    (
        df.withColumns(
            {
                "dataset_type": F.lit(dataset_type),
                "timeframe": F.lit(timeframe),
                "year": year_part(t),
                "month": month_part(t),
            }
        )
        .hint("rebalance", "exchange", "symbol", "year", "month")
        .sortWithinPartitions(*SILVER_PARTITIONS, time)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*SILVER_PARTITIONS)
        .parquet(root)
    )


def read_silver(spark: SparkSession, root: str, dataset_type: str, timeframe: str) -> DataFrame:
    """A silver dataset over all exchanges, symbols and months, with its year and month; a missing one is an error."""
    schema = SILVER_SCHEMAS[dataset_type]
    parts = [T.StructField(p, T.StringType()) for p in SILVER_PARTITIONS if p not in schema.names]
    path = f"{root}/dataset_type={dataset_type}/exchange=*/symbol=*/timeframe={timeframe}"
    rows = read_if_there(spark, root, path, T.StructType([*schema, *parts]))
    if rows is None:
        raise ValueError(f"missing silver dataset: {dataset_type}")
    return rows.select(*schema.names, "year", "month")


def silver_symbols(spark: SparkSession, root: str, datasets: list[str]) -> DataFrame:
    """(dataset_type, exchange, symbol) of the silver datasets that have files, from folder names; no file is opened.

    A dataset without a folder has no rows here.
    """
    found = []
    for name in datasets:
        reader = spark.read.format("binaryFile").option("basePath", root).option("pathGlobFilter", "*.parquet")
        try:
            files = reader.load(f"{root}/dataset_type={name}/exchange=*/symbol=*")
        except AnalysisException as problem:
            if problem.getCondition() != "PATH_NOT_FOUND":
                raise
            continue
        found.append(files.select("dataset_type", "exchange", "symbol").distinct())
    empty = spark.createDataFrame([], "dataset_type string, exchange string, symbol string")
    return union_relaxed(empty, *found)


def write_gold(df: DataFrame, root: str, dataset_id: str, version: str | Column) -> None:
    """Gold rows partitioned by dataset, version, exchange and symbol; a version is replaced as a whole."""
    label = version if isinstance(version, Column) else F.lit(version)
    (
        df.withColumns({"dataset_id": F.lit(dataset_id), "feature_set_version": label})
        .hint("rebalance", "exchange", "symbol")
        .sortWithinPartitions(*GOLD_PARTITIONS, "timestamp_m1")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*GOLD_PARTITIONS)
        .parquet(root)
    )


def write_stats_csv(stats: DataFrame, path: str) -> None:
    """The statistics table (five rows) as one CSV file with a header."""
    stats.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


# ---- order-book artifacts -------------------------------------------------------------------------


def latest_artifact(files: DataFrame) -> DataFrame:
    """Newest order-book artifact per exchange and canonical symbol.

    An artifact is a ``exchange=/symbol=/version=/build_id=`` folder, or a flat ``<SYMBOL>_L2_*.parquet`` file. Flat
    files belong to any exchange (null here) and count only for symbols without a folder.
    """
    from tidelake.functions.symbols import canon_symbol

    folder = r"^(.*/exchange=([^/]+)/symbol=([^/]+)/version=[^/]+/build_id=[^/]+)/[^/]+\.parquet$"
    flat = r"/([^/]+?)_L2_[^/]*\.parquet$"
    nested = F.regexp_extract("path", folder, 1)
    keyed = files.select(
        F.when(nested != "", nested).otherwise(F.col("path")).alias("path"),
        "modificationTime",
        F.nullif(F.regexp_extract("path", folder, 2), F.lit("")).alias("exchange"),
        canon_symbol(
            F.when(nested != "", F.regexp_extract("path", folder, 3)).otherwise(F.regexp_extract("path", flat, 1))
        ).alias("symbol"),
    ).where("symbol <> ''")
    artifacts = keyed.groupBy("exchange", "symbol", "path").agg(F.max("modificationTime").alias("modificationTime"))
    newest = keep_latest(artifacts, ["exchange", "symbol"], ["modificationTime", "path"])
    nested_only = newest.where("exchange is not null")
    flat_only = newest.where("exchange is null").join(nested_only.select("symbol").distinct(), "symbol", "left_anti")
    return nested_only.unionByName(flat_only.select(*newest.columns))


def read_latest_artifacts(spark: SparkSession, root: str, schema: T.StructType | None = None) -> DataFrame:
    """Rows of the newest order-book artifact of every symbol; version and build id are left out.

    Which artifacts these are is a table that is joined with the folder levels, so the planner prunes older builds without a
    path list on the driver. ``schema`` names the columns of the files; without it all footers are merged, as builds may have
    columns of their own. Exchange and symbol come from the folder names where there are any.
    """
    files = list_artifacts(spark, root)
    if files is None:
        raise ValueError(f"no order-book files under {root}")
    chosen = settle(latest_artifact(files), "newest-artifacts")
    reader = spark.read.option("pathGlobFilter", "*.parquet")
    reader = reader.schema(schema) if schema is not None else reader.option("mergeSchema", "true")
    kinds = {r.nested for r in chosen.select(F.col("exchange").isNotNull().alias("nested")).distinct().collect()}
    frames, levels = [], ["exchange", "symbol", "version", "build_id"]
    if True in kinds:
        named = chosen.where("exchange > ''").select(
            F.regexp_extract("path", r"^(.*?)/exchange=", 1).alias("_base"), *[F.regexp_extract("path", f"/{c}=([^/]+)", 1).alias(c) for c in levels]
        )
        for place in sorted(r[0] for r in named.select("_base").distinct().collect()):  # the root, or the dataset's folder in it
            stored = reader.option("basePath", place).parquet("/".join([place, *[f"{c}=*" for c in levels]]))
            kept = [c for c in stored.columns if c not in ("dataset_id", "version", "build_id")]
            frames.append(stored.join(named.where(F.col("_base") == place), levels, "left_semi").select(*kept))
    if False in kinds:
        flat = spark.read.option("pathGlobFilter", "*_L2_*.parquet").option("recursiveFileLookup", "true")
        flat = flat.schema(schema) if schema is not None else flat.option("mergeSchema", "true")
        place = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
        paths = chosen.where("exchange IS NULL").select(_plain("path").alias("_path"))
        rows = flat.parquet(root)
        frames.append(rows.withColumn("_path", _plain(place)).join(paths, "_path", "left_semi").select(*rows.columns))
    if not frames:
        raise ValueError(f"no order-book files under {root}")
    return union_relaxed(*frames)


def _plain(path: Column | str) -> Column:
    """A path with a single slash after its scheme, however it was written."""
    return F.regexp_replace(path, r"^([A-Za-z0-9]+):/+", "$1:/")
