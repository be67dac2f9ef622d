from __future__ import annotations

import json
from hashlib import sha256

import pytest
from conftest import ts
from helpers import rows
from pyspark.sql import functions as F

from tidelake.operators import governance, profile, quality
from tidelake.plans import gold
from tidelake.schemas import SILVER_SCHEMAS
from tidelake.sources import lake

NAMES = {"spot": "BTC_USDC", "perp": "BTC-PERPETUAL", "option_trades_1m_feature": "BTC"}


def silver_rows(spark, name, minutes):
    schema = SILVER_SCHEMAS[name]
    made = []
    for i, minute in enumerate(minutes):
        row = {"exchange": "deribit", "symbol": NAMES.get(name, "BTC-PERPETUAL")}
        for field in schema:
            kind = field.dataType.simpleString()
            if field.name in ("open_time", "timestamp_m1", "timestamp"):
                row[field.name] = ts(minute)
            elif kind == "timestamp":
                row[field.name] = ts(minute)
            elif kind == "double":
                row[field.name] = 100.0 + i
            elif kind == "bigint":
                row[field.name] = i
            elif kind == "boolean":
                row[field.name] = True
        made.append(tuple(row.get(f.name) for f in schema))
    return spark.createDataFrame(made, schema)


def raw_inputs(spark, dataset_id, minutes):
    return {n: silver_rows(spark, n, minutes) for n in gold.gold_inputs(dataset_id)}


TWO = ["2026-05-01 00:00:00", "2026-05-01 00:01:00"]


def test_full_gold(spark):
    raw = raw_inputs(spark, "gold.market.full.m1", TWO)
    merged = gold.gold_frame(raw, "gold.market.full.m1")
    assert merged.count() == 2
    assert len(merged.columns) == 46
    assert merged.columns[:3] == ["timestamp_m1", "exchange", "symbol"]
    assert merged.columns[-1] == "option_trades_buy_volume_share"
    assert rows(merged.select("symbol").distinct()) == [("BTC",)]


def test_grid_keeps_missing_minutes(spark):
    raw = raw_inputs(spark, "gold.market.core.m1", ["2026-05-01 00:00:00", "2026-05-01 00:02:00"])
    merged = gold.gold_frame(raw, "gold.market.core.m1")
    assert merged.count() == 3
    assert merged.where("spot_close_price is null").count() == 1
    span = profile.span_coverage(merged, ["exchange", "symbol"], "timestamp_m1").first()
    assert (span.expected_minutes, span.missing_minutes, span.coverage_ratio) == (3, 0, 1.0)
    audit = {r.column_name: r.missing for r in profile.missing_audit(merged, ["exchange", "symbol"]).collect()}
    assert audit["spot_close_price"] == 1 and audit["timestamp_m1"] == 0
    assert profile.missing_audit(merged, ["exchange", "symbol"]).first().missing_total == 10


def test_symbols_without_all_inputs_are_left_out(spark):
    raw = raw_inputs(spark, "gold.market.core.m1", TWO)
    raw["spot"] = raw["spot"].unionByName(raw["spot"].withColumn("symbol", F.lit("ETH_USDC")))
    assert rows(gold.gold_frame(raw, "gold.market.core.m1").select("symbol").distinct()) == [("BTC",)]


def test_no_common_symbol_gives_no_rows(spark):
    raw = raw_inputs(spark, "gold.market.core.m1", TWO)
    raw["spot"] = raw["spot"].withColumn("symbol", F.lit("ETH_USDC"))
    assert gold.gold_frame(raw, "gold.market.core.m1").count() == 0


def test_unknown_ids(spark):
    with pytest.raises(ValueError):
        gold.gold_inputs("gold.market.nothing")
    with pytest.raises(ValueError):
        gold.prepare("nothing", spark.range(1))


def l2_rows(spark, ratios):
    made = [(ts(f"2026-05-01 00:0{i}:30"), "deribit", "BTC", 5, r) for i, r in enumerate(ratios)]
    return spark.createDataFrame(made, "ts_minute timestamp, exchange string, symbol string, snapshot_count bigint, coverage_ratio double")


def test_l2_modes(spark):
    raw = raw_inputs(spark, "gold.hybrid.full_l2.m1", TWO)
    raw["gold_l2_m1"] = l2_rows(spark, [1.2, 0.9])
    with pytest.raises(ValueError):
        gold.gold_frame(raw, "gold.hybrid.full_l2.m1", "strict")
    kept = gold.gold_frame(raw, "gold.hybrid.full_l2.m1", "lenient")
    assert rows(kept, "timestamp_m1", "l2_coverage_ratio") == [(ts("2026-05-01 00:01:00"), 0.9)]
    prepared = {n: gold.prepare(n, f) for n, f in raw.items()}
    counts = gold.l2_counts(gold.family_spans(prepared), prepared["gold_l2_m1"]).first()
    assert (counts.l2_invalid_rows_found, counts.l2_invalid_rows_dropped) == (1, 1)
    with pytest.raises(ValueError):
        gold.gold_frame(raw, "gold.hybrid.full_l2.m1", "loose")


@pytest.mark.parametrize("ratios", [[0.5], [1.5, 0.9, None, 2.0], [None, None], [0.1, 1.1, 0.2, 0.3, 5.0, 0.4]])
def test_l2_counts_equal_those_of_the_join(spark, ratios):
    minutes = [f"2026-05-01 00:0{i}:00" for i in (1, 2, 4)]
    raw = raw_inputs(spark, "gold.hybrid.full_l2.m1", minutes)
    made = l2_rows(spark, [r if r is not None else float("nan") for r in ratios])
    raw["gold_l2_m1"] = made.withColumn("coverage_ratio", F.nanvl("coverage_ratio", F.lit(None)))
    prepared = {n: gold.prepare(n, f) for n, f in raw.items()}
    spans = gold.family_spans(prepared)
    merged = gold.merge_families(prepared)
    assert rows(gold.l2_counts(spans, prepared["gold_l2_m1"])) == rows(quality.l2_audit(merged))


def test_a_repeated_build_leaves_one_manifest_row(spark, tmp_path):
    silver_root, gold_root = str(tmp_path / "silver"), str(tmp_path / "gold")
    for n in ("spot", "perp"):
        lake.write_silver(silver_rows(spark, n, TWO), silver_root, n, "1m", "open_time")
    for at in ("2026-06-01", "2026-06-01", "2026-06-02"):
        row = gold.build_gold(spark, silver_root, gold_root, "gold.market.core.m1", at, version="v1.0.0").first()
        assert row.l2_validation_mode is None
    stored = spark.read.json(f"{gold_root}/_manifests")
    assert rows(stored, "build_date_utc", "rows_out") == [("2026-06-01T00:00:00Z", 2), ("2026-06-02T00:00:00Z", 2)]


def test_newest_artifacts_of_digit_symbols_and_flat_files(spark, tmp_path):
    root = str(tmp_path / "l2")
    book = l2_rows(spark, [0.5]).drop("exchange", "symbol")
    for symbol, build, ratio in (("007", "a", 0.1), ("007", "b", 0.2), ("BTC", "c", 0.3)):
        book.withColumn("coverage_ratio", F.lit(ratio)).coalesce(1).write.parquet(f"{root}/exchange=deribit/symbol={symbol}/version=1/build_id={build}")
    flat = l2_rows(spark, [0.7]).withColumn("symbol", F.lit("ETH"))
    for name, ratio in (("old", 0.6), ("new", 0.7)):
        flat.withColumn("coverage_ratio", F.lit(ratio)).toPandas().to_parquet(tmp_path / "l2" / f"ETH_L2_{name} +x_y.parquet", coerce_timestamps="us")
    got = lake.read_latest_artifacts(spark, root)
    assert rows(got, "exchange", "symbol", "coverage_ratio") == [("deribit", "007", 0.2), ("deribit", "BTC", 0.3), ("deribit", "ETH", 0.7)]
    fixed = lake.read_latest_artifacts(spark, root, l2_rows(spark, [0.5]).schema)
    assert rows(fixed, "exchange", "symbol", "coverage_ratio") == rows(got, "exchange", "symbol", "coverage_ratio")


def test_lenient_l2_drops_minutes_without_data_only_next_to_bad_rows(spark):
    minutes = [*TWO, "2026-05-01 00:02:00"]
    raw = raw_inputs(spark, "gold.hybrid.full_l2.m1", minutes)
    raw["gold_l2_m1"] = l2_rows(spark, [0.5, 0.9])
    assert gold.gold_frame(raw, "gold.hybrid.full_l2.m1", "lenient").count() == 3
    raw["gold_l2_m1"] = l2_rows(spark, [1.5, 0.9])
    assert gold.gold_frame(raw, "gold.hybrid.full_l2.m1", "lenient").count() == 1
    merged = gold.merge_families({n: gold.prepare(n, f) for n, f in raw.items()})
    assert quality.l2_lenient(merged, quality.l2_audit(merged), keep_null_l2=True).count() == 2


def test_l2_needs_its_columns(spark):
    with pytest.raises(ValueError):
        gold.prep_l2(spark.range(1))
    with pytest.raises(ValueError):
        quality.l2_invalid(["l2_spread"])


def test_duplicate_minutes_are_refused(spark):
    raw = raw_inputs(spark, "gold.market.core.m1", [TWO[0], TWO[0]])
    merged = gold.gold_frame(raw, "gold.market.core.m1")
    with pytest.raises(ValueError, match="BTC"):
        gold.require_one_row_per_minute(merged)


def test_manifest_hashes_match_canonical_json(spark):
    raw = raw_inputs(spark, "gold.market.core.m1", TWO)
    merged = gold.gold_frame(raw, "gold.market.core.m1")
    row = gold.gold_manifest(merged, raw, "gold.market.core.m1", "2026-06-01", "abcdef0123456789").first()

    def short(payload):
        text = json.dumps(payload, sort_keys=True, separators=(",", ":"))
        return sha256(text.encode()).hexdigest()[:12]

    signature = {
        "columns": merged.columns,
        "join_policy": "minute_grid_left_join_coalesce",
        "source_dataset_keys": ["perp_1m", "spot_1m"],
    }
    sources = {
        f"{n}_1m": {"columns": raw[n].columns, "rows": 2, "source_symbols": [NAMES[n]]} for n in ("spot", "perp")
    }
    assert row.feature_set_hash == short({"dataset_id": "gold.market.core.m1", "contract_signature": signature})
    assert row.source_data_hash == short({"source_silver_datasets": sources})
    assert row.column_hash == sha256("|".join(merged.columns).encode()).hexdigest()[:12]
    assert row.build_id == f"{row.feature_set_hash}_{row.source_data_hash}_abcdef01"
    assert (row.rows_out, row.expected_minutes_in_span, row.missing_minutes_in_span) == (2, 2, 0)


def test_build_gold_versions(spark, tmp_path):
    silver_root, gold_root = str(tmp_path / "silver"), str(tmp_path / "gold")

    def store(minutes):
        for n in ("spot", "perp"):
            lake.write_silver(silver_rows(spark, n, minutes), silver_root, n, "1m", "open_time")

    def build(day, **options):
        return gold.build_gold(spark, silver_root, gold_root, "gold.market.core.m1", day, **options).first()

    store(TWO)
    first = build("2026-06-01")
    assert (first.dataset_version, first.version_bump_level, first.rows_out) == ("v1.0.0", "initial", 2)
    same = build("2026-06-02")
    assert (same.dataset_version, same.version_bump_level, same.previous_version) == ("v1.0.0", "none", "v1.0.0")
    store([*TWO, "2026-05-01 00:02:00"])
    patched = build("2026-06-03")
    assert (patched.dataset_version, patched.version_bump_reason, patched.rows_out) == ("v1.0.1", "source_data_changed", 3)
    manual = build("2026-06-04", version="v7.0.0")
    assert (manual.dataset_version, manual.version_bump_level) == ("v7.0.0", "manual")
    stored = spark.read.parquet(gold_root)
    assert rows(stored.groupBy("feature_set_version").count()) == [("v1.0.0", 2), ("v1.0.1", 3), ("v7.0.0", 3)]
    with pytest.raises(ValueError):
        build("2026-06-05", version="1.0")


def test_availability(spark):
    listed = spark.createDataFrame(
        [("spot", "deribit", "BTC_USDC"), ("perp", "deribit", "BTC-PERPETUAL"), ("spot", "deribit", "ETH_USDC")],
        "dataset_type string, exchange string, symbol string",
    )
    assert rows(gold.gold_symbols(listed, "gold.market.core.m1")) == [("deribit", "BTC")]
    plan = gold.build_availability(listed, ["gold.market.core.m1"])
    assert rows(plan, "symbol", "buildable", "missing_inputs") == [("BTC", True, ""), ("ETH", False, "perp")]


# ---- contracts and versions -----------------------------------------------------------------------


def contract(columns, keys, policy="minute_grid_left_join_coalesce"):
    return (columns, policy, keys)


PAIRS = [
    (contract(["a", "b"], ["s"]), contract(["a", "b"], ["s"]), "h", "h", ("none", "no_change")),
    (contract(["a", "b"], ["s"]), contract(["a", "b"], ["s"]), "h", "i", ("patch", "source_data_changed")),
    (contract(["a", "b"], ["s"]), contract(["b", "a"], ["s"]), "h", "h", ("major", "column_order_changed")),
    (contract(["a"], ["s"]), contract(["a", "b"], ["s"]), "h", "h", ("minor", "column_added")),
    (contract(["a", "b"], ["s"]), contract(["a"], ["s"]), "h", "h", ("major", "column_removed_or_renamed")),
    (contract(["a"], ["s"]), contract(["a"], ["s", "t"]), "h", "h", ("minor", "source_dataset_added")),
    (contract(["a"], ["s", "t"]), contract(["a"], ["s"]), "h", "h", ("major", "source_dataset_removed")),
    (contract(["a"], ["s"], "x"), contract(["a"], ["s"]), "h", "h", ("major", "join_policy_changed")),
    (contract(None, ["s"]), contract(["a"], ["s"]), "h", "h", ("major", "invalid_contract_signature")),
    (contract(["a"], None), contract(["a"], ["s"]), "h", "h", ("major", "invalid_source_dataset_keys")),
]


def test_drift_rules(spark):
    kind = "struct<columns: array<string>, join_policy: string, source_dataset_keys: array<string>>"
    table = spark.createDataFrame([(i, *p[:4]) for i, p in enumerate(PAIRS)], f"i int, a {kind}, b {kind}, ha string, hb string")
    step = governance.drift(F.col("a"), F.col("b"), F.col("ha"), F.col("hb"))
    got = {r.i: (r.s.level, r.s.reason) for r in table.select("i", step.alias("s")).collect()}
    assert got == {i: p[4] for i, p in enumerate(PAIRS)}


def test_timeline_equals_stepwise_bumps(spark):
    import random

    random.seed(3)
    levels = ["initial"] + [random.choice(["major", "minor", "patch", "none", "patch"]) for _ in range(120)]
    table = spark.createDataFrame(
        [("d", "e", "s", i, level) for i, level in enumerate(levels)],
        "dataset_id string, exchange string, symbol string, built_at int, level string",
    )
    version, expected = [2, 3, 4], []
    for level in levels:
        if level == "major":
            version = [version[0] + 1, 0, 0]
        elif level == "minor":
            version = [version[0], version[1] + 1, 0]
        elif level == "patch":
            version[2] += 1
        expected.append("v{}.{}.{}".format(*version))
    timeline = governance.semver_timeline(table, "v2.3.4").orderBy("built_at")
    assert [r.dataset_version for r in timeline.collect()] == expected
    with pytest.raises(ValueError):
        governance.parse_version("1.2")


def test_bump_version_errors(spark):
    one = spark.range(1)
    assert one.select(governance.bump_version(F.lit("v1.2.3"), F.lit("minor"))).first()[0] == "v1.3.0"
    for version, level in (("1.2", "minor"), ("v1.2.3", "huge")):
        with pytest.raises(Exception, match="cannot bump"):
            one.select(governance.bump_version(F.lit(version), F.lit(level))).collect()


def test_build_hybrid_gold(spark, tmp_path):
    silver_root, gold_root, l2_root = (str(tmp_path / n) for n in ("silver", "gold", "l2"))
    dataset = "gold.hybrid.full_l2.m1"
    for n in gold.gold_inputs(dataset):
        time = {"spot": "open_time", "perp": "open_time", "funding_1m_feature": "timestamp"}.get(n, "timestamp_m1")
        lake.write_silver(silver_rows(spark, n, TWO), silver_root, n, "1m", time)
    book = l2_rows(spark, [1.2, 0.9]).withColumns({"version": F.lit("v1"), "build_id": F.lit("b")})
    folder = f"{l2_root}/exchange=deribit/symbol=BTC/version=v1/build_id=b"
    book.drop("version", "build_id").coalesce(1).write.parquet(folder)
    with pytest.raises(ValueError, match="1 bad rows"):
        gold.build_gold(spark, silver_root, gold_root, dataset, "2026-06-01", l2_root=l2_root)
    row = gold.build_gold(spark, silver_root, gold_root, dataset, "2026-06-01", l2_root=l2_root, l2_mode="lenient").first()
    assert (row.rows_out, row.l2_invalid_rows_found, row.l2_invalid_rows_dropped) == (1, 1, 1)
    assert row.l2_validation_mode == "lenient"
    assert row.contract.source_dataset_keys[:2] == ["funding_1m_feature", "gold_l2_m1"]
    assert spark.read.parquet(gold_root).select("l2_coverage_ratio").first()[0] == 0.9
    ids = [dataset, "gold.market.core.m1"]
    strict = gold.build_all_gold(spark, silver_root, gold_root, "2026-06-01", ids, l2_root)
    assert rows(strict, "dataset_id", "status", "missing_inputs", "rows_out") == [
        (dataset, "skipped", None, None), ("gold.market.core.m1", "built", None, 2),
    ]
    no_book = gold.build_all_gold(spark, silver_root, gold_root, "2026-06-01", [dataset], str(tmp_path / "none"))
    assert rows(no_book, "status", "missing_inputs") == [("skipped", "gold_l2_m1")]


def test_a_lenient_build_without_good_book_rows_is_empty(spark, tmp_path):
    silver_root, gold_root, l2_root = (str(tmp_path / n) for n in ("silver", "gold", "l2"))
    dataset = "gold.hybrid.full_l2.m1"
    raw = raw_inputs(spark, dataset, TWO) | {"gold_l2_m1": l2_rows(spark, [1.2, 1.5])}
    for n in gold.gold_inputs(dataset):
        time = {"spot": "open_time", "perp": "open_time", "funding_1m_feature": "timestamp"}.get(n, "timestamp_m1")
        lake.write_silver(silver_rows(spark, n, TWO), silver_root, n, "1m", time)

    def build(ratios, name, **options):
        folder = f"{l2_root}/exchange=deribit/symbol=BTC/version=v1/build_id={name}"
        l2_rows(spark, ratios).coalesce(1).write.parquet(folder)
        return gold.build_gold(spark, silver_root, gold_root, dataset, "2026-06-01", l2_root=l2_root, l2_mode="lenient", **options)

    with pytest.raises(ValueError, match="the order-book check leaves no rows"):
        build([1.2, 1.5], "a")
    assert build([1.2, 1.5], "b", may_be_empty=True).count() == 0
    empty = gold.read_gold(spark, gold_root, dataset, raw)
    assert empty.count() == 0
    assert build([0.5, 1.5], "c", may_be_empty=True).count() == 1
    stored = gold.read_gold(spark, gold_root, dataset, raw)
    assert rows(stored, "exchange", "symbol", "feature_set_version", "l2_coverage_ratio") == [("deribit", "BTC", "v1.0.0", 0.5)]
    assert stored.dtypes == empty.dtypes == spark.read.parquet(f"{gold_root}/dataset_id={dataset}").dtypes


def test_the_hybrid_build_over_busy_hours_is_empty_as_its_sql_says(spark, tmp_path):
    from tidelake.catalog import QUERIES

    hour = ts("2024-01-01 05:00:00").timestamp()
    made = [(i, hour + i * 20.0, i % 3, "click" if i % 2 else "view", 5.0, '{"k": 20}') for i in range(90)]
    events = spark.createDataFrame(made, "event_id long, at double, user_id long, event_type string, value double, props string")
    events.select("event_id", F.col("at").cast("timestamp").cast("timestamp_ntz").alias("ts"), "user_id", "event_type", "value", "props").write.parquet(str(tmp_path / "events.parquet"))
    got = QUERIES["gold_hybrid_build"](spark, str(tmp_path))
    assert got.count() == 0 and {"l2_coverage_ratio", "l2_invalid_rows_found", "rows_out"} <= set(got.columns)
