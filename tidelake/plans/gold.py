"""Silver to gold: feature families on a dense minute grid, with audit, contract and version."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelake.functions.hashing import columns_hash, json_hash
from tidelake.functions.symbols import canon_symbol
from tidelake.functions.times import at, iso_utc, trunc_minute, utc
from tidelake.operators import governance, quality
from tidelake.operators.grid import grid_left_join, input_bounds, joint_span, minute_grid
from tidelake.operators.profile import metadata_json, metadata_parts, span_coverage
from tidelake.operators.small import join_small, settle
from tidelake.schemas import BAR_COLUMNS, GOLD_INPUTS, GOLD_KEY, GOLD_PARTITIONS, GOLD_WITH_L2, L2_INPUT, gold_inputs, source_key
from tidelake.sources.lake import latest_artifact, list_artifacts, read_latest_artifacts, read_silver, silver_symbols, write_gold
from tidelake.sources.manifests import append_manifests, read_manifests, with_contract
from tidelake.sources.paths import read_if_there

BIGINT_BARS = {"trade_count", "buy_trade_count", "sell_trade_count"}


# ---- preparing inputs -----------------------------------------------------------------------------


def _keys(time: Column) -> list[Column]:
    return [utc(time).alias("timestamp_m1"), F.col("exchange"), canon_symbol(F.col("symbol")).alias("symbol")]


def prep_candles(frame: DataFrame, prefix: str) -> DataFrame:
    names = ["open_price", "high_price", "low_price", "close_price", "volume"]
    return frame.select(
        *_keys(F.col("open_time")), *[F.col(n).cast("double").alias(f"{prefix}_{n}") for n in names]
    )


def prep_oi(frame: DataFrame) -> DataFrame:
    return frame.select(
        *_keys(F.col("timestamp_m1")),
        F.col("open_interest").cast("double").alias("oi_open_interest"),
        F.col("oi_is_observed").cast("boolean"),
        F.col("oi_is_ffill").cast("boolean"),
        F.col("minutes_since_oi_observation").cast("bigint"),
        F.col("oi_observation_lag_sec").cast("bigint"),
    )


def prep_funding(frame: DataFrame) -> DataFrame:
    return frame.select(
        *_keys(F.col("timestamp")),
        F.col("funding_rate_last_known").cast("double"),
        F.col("minutes_since_funding").cast("bigint"),
        F.col("is_funding_observation_minute").cast("boolean"),
        F.col("funding_data_available").cast("boolean"),
    )


def prep_bars(frame: DataFrame, prefix: str) -> DataFrame:
    kinds = {n: "bigint" if n in BIGINT_BARS else "double" for n in BAR_COLUMNS}
    return frame.select(
        *_keys(F.col("timestamp_m1")), *[F.col(n).cast(k).alias(f"{prefix}_{n}") for n, k in kinds.items()]
    )


def prep_l2(frame: DataFrame, exchange: str = "deribit", symbol: str | None = None) -> DataFrame:
    """Order-book minutes: whole minutes, and ``l2_`` before every column that is not a key.

    ``exchange`` and ``symbol`` stand in for key columns a file lacks.
    """
    if "ts_minute" not in frame.columns:
        raise ValueError("order-book table lacks ts_minute")
    keyed = frame
    for name, value in (("exchange", exchange), ("symbol", symbol)):
        if name not in frame.columns:
            if value is None:
                raise ValueError(f"order-book table lacks {name}")
            keyed = keyed.withColumn(name, F.lit(value))
    rest = [c for c in frame.columns if c not in ("ts_minute", "exchange", "symbol")]
    return keyed.select(
        *_keys(trunc_minute(utc(F.col("ts_minute")))), *[F.col(c).alias(f"l2_{c}") for c in rest]
    )


def prepare(dataset_type: str, frame: DataFrame) -> DataFrame:
    """The gold columns of one input."""
    if dataset_type in ("spot", "perp"):
        return prep_candles(frame, dataset_type)
    preparers = {
        "oi_1m_feature": prep_oi,
        "funding_1m_feature": prep_funding,
        "perp_trades_1m_feature": lambda f: prep_bars(f, "trades"),
        "option_trades_1m_feature": lambda f: prep_bars(f, "option_trades"),
        L2_INPUT: prep_l2,
    }
    if dataset_type not in preparers:
        raise ValueError(f"no gold preparation for {dataset_type}")
    return preparers[dataset_type](frame)


# ---- symbols --------------------------------------------------------------------------------------


def gold_symbols(symbols: DataFrame, dataset_id: str) -> DataFrame:
    """Canonical symbols present in every input of a gold dataset.

    ``symbols`` lists (dataset_type, exchange, symbol); the result is grouped by exchange.
    """
    required = gold_inputs(dataset_id)
    return (
        symbols.where(F.col("dataset_type").isin(required))
        .groupBy("exchange", canon_symbol(F.col("symbol")).alias("symbol"))
        .agg(F.count_distinct("dataset_type").alias("_have"))
        .where(F.col("_have") == len(required))
        .select("exchange", "symbol")
    )


def build_availability(symbols: DataFrame, dataset_ids: list[str], with_book: bool = False) -> DataFrame:
    """Which (dataset, exchange, symbol) can be built, and the inputs missing for those that are skipped.

    ``with_book`` counts the order-book table among the inputs of datasets that take one.
    """
    canon = symbols.select("dataset_type", "exchange", canon_symbol(F.col("symbol")).alias("symbol"))
    have = canon.groupBy("exchange", "symbol").agg(F.collect_set("dataset_type").alias("_have"))
    needs = F.array(
        *[
            F.struct(F.lit(d).alias("dataset_id"), F.array(*[F.lit(i) for i in gold_inputs(d) + ([L2_INPUT] if with_book and d in GOLD_WITH_L2 else [])]).alias("inputs"))
            for d in dataset_ids
        ]
    )
    missing = F.array_sort(F.array_except("inputs", "_have"))
    return have.select("exchange", "symbol", "_have", F.inline(needs)).select(
        "dataset_id",
        "exchange",
        "symbol",
        (F.size(missing) == 0).alias("buildable"),
        F.array_join(missing, ",").alias("missing_inputs"),
    )


# ---- the joined table -----------------------------------------------------------------------------


def family_spans(prepared: dict[str, DataFrame]) -> DataFrame:
    """First and last minute of the symbols that every input has.

    The spans (one row per symbol) are settled, so that the inputs' bounds are taken once, and so that the optimizer
    does not copy the bounds plan into the scan of every joined input as a pruning filter.
    """
    return settle(joint_span(input_bounds(prepared), len(prepared)), "spans")


def merge_families(prepared: dict[str, DataFrame]) -> DataFrame:
    """All inputs on the dense minute grid of the symbols that every input has."""
    return grid_left_join(minute_grid(family_spans(prepared)), prepared)


def require_one_row_per_minute(merged: DataFrame) -> None:
    """Fail when an input had a minute twice: the grid has each minute once, so rows then exceed the minutes spanned."""
    span = span_coverage(merged, ["exchange", "symbol"], "timestamp_m1")
    crowded = span.where("rows_out > expected_minutes").select("symbol").limit(5).collect()
    if crowded:
        raise ValueError(f"an input has more than one row per minute for {[r.symbol for r in crowded]}")


def l2_counts(spans: DataFrame, book: DataFrame) -> DataFrame:
    """Order-book check counts per symbol of the joined table, without joining it: the minutes of the span are known, and
    those without an order-book row are the ones that no row inside the span stands for."""
    bad = quality.l2_invalid(book.columns)
    minutes = book.groupBy(*GOLD_KEY).agg(F.count(F.lit(1)).alias("_rows"), F.count_if(bad).alias("_bad"), F.count_if(~bad).alias("_good"))
    since = F.expr("unix_micros(timestamp_m1) - unix_micros(first_minute)")
    inside = (F.col("timestamp_m1") <= F.col("last_minute")) & (since >= 0) & (since % 60_000_000 == 0)
    met = F.when(inside, F.struct("_rows", "_bad", "_good"))
    joined = spans.select(*GOLD_KEY[1:], "first_minute", "last_minute").join(minutes, GOLD_KEY[1:], "left").select("*", met.alias("_met"))
    length = F.expr("(unix_micros(first(last_minute)) - unix_micros(first(first_minute))) div 60000000") + 1
    counts = joined.groupBy(*GOLD_KEY[1:]).agg(
        length.alias("_minutes"), F.count("_met").alias("_held"), *[F.coalesce(F.sum(f"_met.{c}"), F.lit(0)).alias(c) for c in ("_rows", "_bad", "_good")]
    )
    total = F.col("_minutes") - F.col("_held") + F.col("_rows")
    dropped = F.when(F.col("_bad") > 0, total - F.col("_good")).otherwise(F.lit(0))
    return counts.select(*GOLD_KEY[1:], F.col("_bad").alias("l2_invalid_rows_found"), dropped.alias("l2_invalid_rows_dropped"))


def check_l2(merged: DataFrame, audit: DataFrame, mode: str) -> DataFrame:
    """The rows a mode keeps: strict fails on any bad row, skip leaves out symbols that have one, lenient drops rows."""
    if mode not in ("strict", "skip", "lenient"):
        raise ValueError(f"unknown order-book check mode: {mode}")
    if mode == "lenient":
        return quality.l2_lenient(merged, audit)
    if mode == "skip":
        return join_small(merged, audit.where("l2_invalid_rows_found = 0").select("exchange", "symbol"), ["exchange", "symbol"], "left_semi")
    found = audit.agg(F.sum("l2_invalid_rows_found").alias("n")).first().n
    if found:
        raise ValueError(f"order-book check failed: {found} bad rows")
    return merged


def gold_frame(raw: dict[str, DataFrame], dataset_id: str, l2_mode: str = "strict") -> DataFrame:
    """The gold table of a dataset id from its silver inputs (and ``gold_l2_m1`` where it takes order-book rows)."""
    names = gold_inputs(dataset_id) + ([L2_INPUT] if dataset_id in GOLD_WITH_L2 else [])
    prepared = {n: prepare(n, raw[n]) for n in names}
    spans = family_spans(prepared)
    merged = grid_left_join(minute_grid(spans), prepared)
    return check_l2(merged, l2_counts(spans, prepared[L2_INPUT]), l2_mode) if dataset_id in GOLD_WITH_L2 else merged


# ---- manifest -------------------------------------------------------------------------------------


def source_facts(raw: dict[str, DataFrame]) -> DataFrame:
    """Per exchange and canonical symbol, a struct column per input with its columns, rows and stored symbols."""
    parts = []
    for name, frame in raw.items():
        columns = F.array(*[F.lit(c) for c in frame.columns])
        facts = F.struct(
            columns.alias("columns"),
            F.count(F.lit(1)).alias("rows"),
            F.array_sort(F.collect_set("symbol")).alias("source_symbols"),
        )
        key = ["exchange", canon_symbol(F.col("symbol")).alias("_symbol")]
        parts.append(
            frame.groupBy(*key).agg(facts.alias(source_key(name))).withColumnRenamed("_symbol", "symbol")
        )
    return reduce(lambda a, b: a.join(b, ["exchange", "symbol"]), parts)


def gold_manifest(
    merged: DataFrame, raw: dict[str, DataFrame], dataset_id: str, built_at: datetime | str, code_version: str = "nogit"
) -> DataFrame:
    """One manifest row per symbol: span, coverage, nulls, contract, hashes and build id (version fields come later)."""
    columns = merged.columns
    listed = F.array(*[F.lit(c) for c in columns])
    expected = F.expr("(unix_micros(max(timestamp_m1)) - unix_micros(min(timestamp_m1))) div 60000000") + 1
    aggs, cells = metadata_parts(merged, "timestamp_m1")
    audit = merged.groupBy(F.col("exchange").alias("_e"), F.col("symbol").alias("_s")).agg(
        F.count(F.lit(1)).alias("_rows"),
        *aggs,
        F.min("timestamp_m1").alias("_first"),
        F.max("timestamp_m1").alias("_last"),
        expected.alias("expected_minutes_in_span"),
        F.struct(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns]).alias("_missing"),
    )
    audit = audit.withColumnsRenamed({"_e": "exchange", "_s": "symbol"}).withColumn("rows_out", F.col("_rows"))
    sources = sorted(source_key(n) for n in raw)
    facts = source_facts(raw).select("exchange", "symbol", F.struct(*sources).alias("source_silver_datasets"))
    total = reduce(lambda a, b: a + b, [F.col(f"_missing.{c}") for c in columns])
    signature = governance.contract(listed, F.array(*[F.lit(s) for s in sources]))
    dataset = F.lit(dataset_id)
    rows = audit.join(facts, ["exchange", "symbol"], "left").withColumns(
        {
            "dataset_id": dataset,
            "contract": signature,
            "feature_set_hash": governance.feature_set_hash(signature, dataset),
            "source_data_hash": json_hash(F.struct("source_silver_datasets")),
        }
    )
    clock = at(built_at)
    return rows.select(
        "dataset_id",
        "exchange",
        "symbol",
        clock.alias("built_at"),
        iso_utc(clock).alias("build_date_utc"),
        columns_hash(listed).alias("column_hash"),
        "feature_set_hash",
        "source_data_hash",
        governance.build_id(F.col("feature_set_hash"), F.col("source_data_hash"), code_version).alias("build_id"),
        F.concat_ws("_", "feature_set_hash", "source_data_hash").alias("hash_string"),
        F.lit(code_version).alias("git_commit_hash"),
        "contract",
        "rows_out",
        iso_utc(F.col("_first")).alias("min_timestamp"),
        iso_utc(F.col("_last")).alias("max_timestamp"),
        "expected_minutes_in_span",
        F.greatest(F.col("expected_minutes_in_span") - F.col("rows_out"), F.lit(0)).alias("missing_minutes_in_span"),
        (F.col("rows_out") / F.col("expected_minutes_in_span")).alias("observed_row_coverage_ratio"),
        total.alias("missing_value_count_total"),
        F.to_json("_missing").alias("missing_value_count_by_column"),
        F.to_json("source_silver_datasets").alias("source_silver_datasets"),
        metadata_json(cells).alias("feature_metadata"),
    )


MANIFEST_SCHEMA = (
    "dataset_id string, exchange string, symbol string, built_at timestamp, source_data_hash string, "
    "columns array<string>, source_dataset_keys array<string>, dataset_version string, "
    "contract struct<columns: array<string>, join_policy: string, source_dataset_keys: array<string>>"
)


def resolve_versions(manifest: DataFrame, history: DataFrame | None, base: str) -> DataFrame:
    """Automatic version per symbol: the newest manifest's version, bumped by how far the contract drifted."""
    governance.parse_version(base)
    if history is None:
        return manifest.withColumns(
            {
                "dataset_version": F.lit(base),
                "previous_version": F.lit(None).cast("string"),
                "version_bump_level": F.lit("initial"),
                "version_bump_reason": F.lit("no_previous_manifest"),
            }
        )
    before = governance.latest_manifest(with_contract(history)).select(
        *governance.ARTIFACT,
        F.coalesce("dataset_version", F.lit(base)).alias("previous_version"),
        F.col("contract").alias("_was"),
        F.coalesce("source_data_hash", F.lit("")).alias("_was_hash"),
    )
    joined = manifest.join(before, governance.ARTIFACT, "left")
    step = governance.drift(F.col("_was"), F.col("contract"), F.col("_was_hash"), F.col("source_data_hash"))
    first = F.struct(F.lit("initial").alias("level"), F.lit("no_previous_manifest").alias("reason"))
    known = F.col("previous_version").isNotNull()
    return (
        joined.withColumn("_step", F.when(known, step).otherwise(first))
        .withColumns(
            {
                "dataset_version": F.when(
                    known, governance.bump_version(F.col("previous_version"), F.col("_step.level"))
                ).otherwise(F.lit(base)),
                "version_bump_level": F.col("_step.level"),
                "version_bump_reason": F.col("_step.reason"),
            }
        )
        .drop("_step", "_was", "_was_hash")
    )


def build_gold(
    spark: SparkSession,
    silver_root: str,
    gold_root: str,
    dataset_id: str,
    built_at: datetime | str,
    l2_root: str | None = None,
    version: str | None = None,
    version_base: str = "v1.0.0",
    l2_mode: str = "strict",
    code_version: str = "nogit",
    may_be_empty: bool = False,
) -> DataFrame:
    """Build, audit, version and write a gold dataset for every symbol that has all inputs; returns the manifest rows.

    Without ``version`` each symbol's version follows from its newest manifest. The joined table is written once to
    the shared scratch folder, so that audit, hashes and the final write read the same rows without joining again.
    """
    raw = {n: read_silver(spark, silver_root, n, "1m").drop("year", "month") for n in gold_inputs(dataset_id)}
    if dataset_id in GOLD_WITH_L2:
        raw[L2_INPUT] = read_latest_artifacts(spark, l2_root or gold_root)
    prepared = {n: prepare(n, frame) for n, frame in raw.items()}
    merged = settle(merge_families(prepared), "gold")
    require_one_row_per_minute(merged)
    counts = None
    if dataset_id in GOLD_WITH_L2:
        counts = settle(quality.l2_audit(merged), "order-book-counts")
        merged = check_l2(merged, counts, l2_mode)
    manifest = gold_manifest(merged, raw, dataset_id, built_at, code_version)
    if counts is None:
        blank = {"l2_validation_mode": "string", "l2_invalid_rows_found": "bigint", "l2_invalid_rows_dropped": "bigint"}
        manifest = manifest.withColumns({c: F.lit(None).cast(kind) for c, kind in blank.items()})
    else:
        # A build over all datasets leaves out single symbols in strict mode; what it checks is the strict rule.
        mode = F.lit("strict" if l2_mode == "skip" else l2_mode)
        manifest = manifest.join(counts, ["exchange", "symbol"], "left").withColumn("l2_validation_mode", mode)
    manifest_root = f"{gold_root}/_manifests"
    if version is not None:
        governance.parse_version(version)
        manifest = manifest.withColumns(
            {
                "dataset_version": F.lit(version),
                "previous_version": F.lit(None).cast("string"),
                "version_bump_level": F.lit("manual"),
                "version_bump_reason": F.lit("manual_version"),
            }
        )
    else:
        manifest = resolve_versions(manifest, read_manifests(spark, manifest_root, MANIFEST_SCHEMA), version_base)
    manifest = settle(manifest, "gold-manifest")
    if manifest.isEmpty():
        if may_be_empty:
            return manifest
        if counts is not None and not counts.isEmpty():
            raise ValueError(f"the order-book check leaves no rows of {dataset_id}")
        raise ValueError(f"no symbol has all inputs of {dataset_id}")
    versions = manifest.select("exchange", "symbol", F.col("dataset_version").alias("_version"))
    labelled = join_small(merged, versions, ["exchange", "symbol"]).withColumnRenamed("_version", "feature_set_version")
    write_gold(labelled, gold_root, dataset_id, F.col("feature_set_version"))
    # A build that is run again finds its rows there: one per artifact, build and clock.
    append_manifests(manifest, manifest_root, ["dataset_id", "exchange", "symbol", "build_id", "build_date_utc"])
    return manifest


def read_gold(spark: SparkSession, gold_root: str, dataset_id: str, raw: dict[str, DataFrame]) -> DataFrame:
    """Stored rows of a gold dataset that is made of ``raw``, with version, exchange and symbol; none if no symbol was built."""
    prepared = [prepare(n, frame) for n, frame in raw.items()]
    fields = [f for frame in prepared for f in frame.schema if f.name not in GOLD_KEY]
    levels = [T.StructField(c, T.StringType()) for c in GOLD_PARTITIONS if c != "dataset_id"]
    schema = T.StructType([prepared[0].schema["timestamp_m1"], *fields, *levels])
    place = f"{gold_root}/dataset_id={dataset_id}"
    stored = read_if_there(spark, place, place, schema)
    return spark.createDataFrame([], schema) if stored is None else stored


BUILT_FIELDS = ["dataset_id", "exchange", "symbol", "dataset_version", "rows_out"]


def book_symbols(spark: SparkSession, l2_root: str, known: DataFrame) -> DataFrame:
    """Symbols with an order-book artifact, as rows of input ``gold_l2_m1``; flat files count for every exchange of ``known``."""
    files = list_artifacts(spark, l2_root)
    if files is None:
        return known.limit(0)
    newest = latest_artifact(files)
    flat = known.select("exchange", canon_symbol(F.col("symbol")).alias("symbol")).distinct().join(
        newest.where("exchange is null").select("symbol"), "symbol", "left_semi"
    )
    both = newest.where("exchange is not null").select("exchange", "symbol").unionByName(flat)
    return both.select(F.lit(L2_INPUT).alias("dataset_type"), "exchange", "symbol")


def build_all_gold(
    spark: SparkSession,
    silver_root: str,
    gold_root: str,
    built_at: datetime | str,
    dataset_ids: list[str] | None = None,
    l2_root: str | None = None,
    l2_mode: str = "strict",
    **options,
) -> DataFrame:
    """Build every gold dataset for the symbols that have its inputs; a row per dataset and symbol says what became of it.

    A symbol that lacks inputs is skipped and ``missing_inputs`` names them. In strict mode a symbol with bad order-book
    rows is skipped by itself, with null ``missing_inputs``, and the others are built. A dataset that no symbol can be
    built for is not an error. The driver sees one row per dataset.
    """
    ids = list(dataset_ids or GOLD_INPUTS)
    listed = settle(silver_symbols(spark, silver_root, sorted({n for d in ids for n in gold_inputs(d)})), "silver-symbols")
    if GOLD_WITH_L2.intersection(ids):
        listed = listed.unionByName(book_symbols(spark, l2_root or gold_root, listed))
    known = settle(build_availability(listed, ids, with_book=True), "availability")
    possible = {r.dataset_id for r in known.where("buildable").select("dataset_id").distinct().collect()}
    manifests = [
        build_gold(
            spark, silver_root, gold_root, d, built_at, l2_root, l2_mode="skip" if l2_mode == "strict" else l2_mode,
            may_be_empty=d in GOLD_WITH_L2, **options,
        ).select(*BUILT_FIELDS)
        for d in ids
        if d in possible
    ]
    if not manifests:
        blank = known.withColumns({"dataset_version": F.lit(None).cast("string"), "rows_out": F.lit(None).cast("bigint")})
    else:
        built = reduce(DataFrame.unionByName, manifests)
        blank = known.join(built, ["dataset_id", "exchange", "symbol"], "left")
    done = F.col("rows_out").isNotNull()
    reason = F.when(~F.col("buildable"), F.col("missing_inputs"))
    return blank.select(
        "dataset_id", "exchange", "symbol", F.when(done, "built").otherwise("skipped").alias("status"),
        reason.alias("missing_inputs"), "dataset_version", "rows_out",
    )
