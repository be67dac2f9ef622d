from __future__ import annotations

import json
from datetime import datetime, timedelta, timezone
from pathlib import Path

import pytest
from conftest import ts
from helpers import bronze, rows
from pyspark.sql import functions as F

from tidelake.plans import combined
from tidelake.plans.bronze import ingest_pages
from tidelake.schemas import BRONZE_PARTITIONS_OLD, BRONZE_SCHEMAS
from tidelake.sources import lake, manifests
from tidelake.streaming.flush import chunk_flush


def candle(open_time, close, symbol="BTC_USDC", **extra):
    return {
        "open_time": open_time, "close_time": open_time, "event_time": open_time, "ingested_at": "2026-05-10", "open_price": 100.0,
        "high_price": 110.0, "low_price": 90.0, "close_price": close, "volume": 1.0, "trade_count": 1, "symbol": symbol, **extra,
    }


def test_last_write_wins_and_repeats_change_nothing(spark, tmp_path):
    root = str(tmp_path / "lake")
    first = bronze(spark, "spot", [candle("2026-05-01 00:00:00", 101.0), candle("2026-05-01 00:01:00", 101.5)])
    again = bronze(spark, "spot", [candle("2026-05-01 00:00:00", 102.0, ingested_at="2026-05-11")])
    lake.upsert_partitions(spark, first, root, "spot")
    for _ in range(2):
        written = lake.upsert_partitions(spark, again, root, "spot")
    assert rows(written, "date", "rows") == [("2026-05-01", 2)]
    stored = lake.scan_lake(spark, root, "spot")
    assert rows(stored, "open_time", "close_price") == [(ts("2026-05-01 00:00:00"), 102.0), (ts("2026-05-01 00:01:00"), 101.5)]


def test_new_rows_win_on_equal_stamps(spark, tmp_path):
    root = str(tmp_path / "lake")
    for close in (101.0, 102.0):
        lake.upsert_partitions(spark, bronze(spark, "spot", [candle("2026-05-01 00:00:00", close)]), root, "spot")
    assert rows(lake.scan_lake(spark, root, "spot"), "close_price") == [(102.0,)]


def test_untouched_days_and_series_stay(spark, tmp_path):
    root = str(tmp_path / "lake")
    days = ["2026-04-30", "2026-05-01", "2026-05-02"]
    lake.upsert_partitions(spark, bronze(spark, "spot", [candle(f"{d} 00:00:00", 1.0) for d in days]), root, "spot")
    lake.upsert_partitions(spark, bronze(spark, "spot", [candle("2026-05-01 00:00:00", 9.0, "ETH_USDC")]), root, "spot")
    late = [candle("2026-04-30 00:00:00", 2.0, ingested_at="2026-05-12"), candle("2026-05-02 00:05:00", 3.0)]
    lake.upsert_partitions(spark, bronze(spark, "spot", late), root, "spot")
    stored = lake.scan_lake(spark, root, "spot")
    assert rows(stored, "symbol", "date", "close_price") == [
        ("BTC_USDC", "2026-04-30", 2.0), ("BTC_USDC", "2026-05-01", 1.0), ("BTC_USDC", "2026-05-02", 1.0),
        ("BTC_USDC", "2026-05-02", 3.0), ("ETH_USDC", "2026-05-01", 9.0),
    ]
    assert lake.upsert_partitions(spark, bronze(spark, "spot", [candle("2026-05-01", 1.0)]).limit(0), root, "spot").count() == 0


def test_a_batch_that_died_while_publishing_is_published_again(spark, tmp_path, monkeypatch):
    root, stage = str(tmp_path / "lake"), str(tmp_path / "stage")
    lake.upsert_partitions(spark, bronze(spark, "spot", [candle("2026-05-01 00:00:00", 1.0)]), root, "spot")
    batch = bronze(spark, "spot", [candle("2026-05-01 00:01:00", 2.0)])
    publish = lake._publish

    def die(*_):
        raise RuntimeError("lost")

    monkeypatch.setattr(lake, "_publish", die)
    with pytest.raises(RuntimeError):
        lake.upsert_partitions(spark, batch, root, "spot", stage=stage)
    monkeypatch.setattr(lake, "_publish", publish)
    # the half-replaced day is gone from the lake; the staged copy has all its rows
    spark.createDataFrame([], BRONZE_SCHEMAS["spot"]).write.mode("overwrite").parquet(root)
    lake.upsert_partitions(spark, batch, root, "spot", stage=stage)
    assert rows(lake.scan_lake(spark, root, "spot"), "close_price") == [(1.0,), (2.0,)]


def test_scan_reads_both_layouts(spark, tmp_path):
    root = str(tmp_path / "lake")
    lake.upsert_partitions(spark, bronze(spark, "spot", [candle("2026-05-01 00:00:00", 1.0)]), root, "spot")
    old = lake.with_partitions(bronze(spark, "spot", [candle("2025-12-31 00:00:00", 2.0)])).drop("year")
    old.write.mode("append").partitionBy(*BRONZE_PARTITIONS_OLD).parquet(root)
    both = lake.scan_lake(spark, root, "spot")
    assert rows(both, "year", "month", "date", "close_price") == [
        ("2025", "2025-12", "2025-12-31", 2.0), ("2026", "2026-05", "2026-05-01", 1.0),
    ]
    assert lake.scan_lake(spark, root, "spot", months="2025-12").count() == 1
    assert lake.scan_lake(spark, root, "spot", symbol="ETH_USDC").count() == 0
    assert lake.scan_lake(spark, root, "perp").count() == 0
    assert rows(lake.discover_months(spark, root, "spot", "deribit", "BTC_USDC", "1m")) == [("2025-12",), ("2026-05",)]
    assert rows(lake.discover_symbols(spark, root, "spot", "deribit", "1m")) == [("BTC_USDC",)]
    assert rows(lake.latest_open_time(spark, root, "spot"), "open_time") == [(ts("2026-05-01 00:00:00"),)]
    assert lake.stored_open_times(both).count() == 2
    # an upsert into an old-layout day merges with it and stays in its layout
    lake.upsert_partitions(spark, bronze(spark, "spot", [candle("2025-12-31 00:01:00", 3.0)]), root, "spot")
    assert rows(lake.scan_lake(spark, root, "spot"), "close_price") == [(1.0,), (2.0,), (3.0,)]
    fix = candle("2025-12-31 00:00:00", 4.0, ingested_at="2027-01-01")
    assert rows(lake.upsert_partitions(spark, bronze(spark, "spot", [fix]), root, "spot"), "date", "rows") == [("2025-12-31", 2)]
    assert rows(lake.scan_lake(spark, root, "spot"), "close_price") == [(1.0,), (3.0,), (4.0,)]


def test_upsert_into_a_day_of_both_layouts(spark, tmp_path):
    root = str(tmp_path / "lake")
    lake.upsert_partitions(spark, bronze(spark, "spot", [candle("2025-12-31 00:00:00", 1.0)]), root, "spot")
    old = lake.with_partitions(bronze(spark, "spot", [candle("2025-12-31 00:01:00", 2.0), candle("2025-12-31 00:02:00", 3.0)])).drop("year")
    old.write.mode("append").partitionBy(*BRONZE_PARTITIONS_OLD).parquet(root)
    later = [candle(f"2025-12-31 00:0{m}:00", 10.0 + m, ingested_at="2027-01-01") for m in (0, 1, 3)]
    lake.upsert_partitions(spark, bronze(spark, "spot", later), root, "spot")
    stored = lake.scan_lake(spark, root, "spot")
    assert sorted(rows(stored, "close_price")) == [(3.0,), (10.0,), (11.0,), (13.0,)]
    lake.upsert_partitions(spark, bronze(spark, "spot", later), root, "spot")
    assert lake.scan_lake(spark, root, "spot").count() == 4


def test_a_run_that_died_while_publishing_is_finished_by_the_next_start(spark, tmp_path, monkeypatch):
    root, publish = str(tmp_path / "lake"), lake._publish
    days = ["2026-05-01", "2026-05-02"]
    lake.sink_bronze(spark, bronze(spark, "spot", [candle(f"{d} 00:00:00", 1.0) for d in days]), root, "spot", "run-1", "2026-05-03")

    def half(rows, target, *more):
        publish(rows.where(F.col("date") == days[0]), target, *more)
        # the second day is taken away and not yet replaced
        lake.scan_lake(spark, root, "spot").where("false").write.mode("overwrite").parquet(
            f"{root}/dataset_type=spot/exchange=deribit/instrument_type=spot/symbol=BTC_USDC/timeframe=1m/year=2026/month=2026-05/date={days[1]}"
        )
        raise RuntimeError("lost")

    monkeypatch.setattr(lake, "_publish", half)
    batch = bronze(spark, "spot", [candle(f"{d} 00:01:00", 2.0) for d in days])
    with pytest.raises(RuntimeError):
        lake.sink_bronze(spark, batch, root, "spot", "run-2", "2026-05-03")
    assert lake.scan_lake(spark, root, "spot").count() == 2
    monkeypatch.setattr(lake, "_publish", publish)
    lake.sink_bronze(spark, batch, root, "spot", "run-2", "2026-05-03")
    assert rows(lake.scan_lake(spark, root, "spot"), "date", "close_price") == [(d, c) for d in days for c in (1.0, 2.0)]
    # the same run id may bring another batch later
    lake.sink_bronze(spark, bronze(spark, "spot", [candle(f"{days[0]} 00:02:00", 3.0)]), root, "spot", "run-2", "2026-05-03")
    assert lake.scan_lake(spark, root, "spot").count() == 5


def test_partition_pruning_reaches_the_scan(spark, tmp_path):
    root = str(tmp_path / "lake")
    lake.upsert_partitions(spark, bronze(spark, "spot", [candle(f"2026-05-0{d} 00:00:00", 1.0) for d in (1, 2, 3)]), root, "spot")
    kept = combined.combined_filters(lake.scan_lake(spark, root, "spot"), start="2026-05-02", end="2026-05-02 23:59:59")
    plan = kept.select("close_price")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan
    assert "ReadSchema: struct<open_time:timestamp,close_price:double>" in plan


def test_typed_load_defaults(spark):
    raw = bronze(spark, "spot", [candle("2026-05-01 00:00:00", 1.0, volume=None, trade_count=None), candle("2026-05-01 00:01:00", 1.0, close_time=None)])
    got = lake.load_typed(raw, "candles").collect()
    assert len(got) == 1 and (got[0].volume, got[0].trade_count, got[0].quote_volume) == (0.0, 0, None)
    named = raw.withColumn("open", F.lit(7.0)).withColumn("open_price", F.lit(None).cast("double"))
    assert lake.load_typed(named, "candles").first().open_price == 7.0


def test_parse_path(spark):
    path = "/x/dataset_type=spot/exchange=d/instrument_type=spot/symbol=B/timeframe=1m/year=2026/month=2026-05/date=2026-05-01/data.parquet"
    one = spark.createDataFrame([(path,), ("/x/dataset_type=spot/data.parquet",)], "p string")
    got = [r.k for r in one.select(lake.parse_partition_path(F.col("p")).alias("k")).collect()]
    assert got[0].asDict() == {
        "dataset_type": "spot", "exchange": "d", "instrument_type": "spot", "symbol": "B", "timeframe": "1m", "date": "2026-05-01",
    }
    assert got[1] is None


@pytest.fixture
def market_lake(spark, tmp_path):
    root = str(tmp_path / "lake")
    perp = [candle("2026-05-01 00:00:00", 100.5, "BTCUSDT")]
    lake.upsert_partitions(spark, bronze(spark, "perp", perp), root, "perp")
    lake.upsert_partitions(spark, bronze(spark, "spot", [candle("2026-05-01 00:00:00", 7.0, "ETHUSDT")]), root, "spot")
    oi = [{"open_time": "2026-05-01 00:00:00", "close_time": "2026-05-01 00:00:00", "ingested_at": "2026-05-02", "open_interest": 123.0, "symbol": "BTCUSDT"}]
    lake.upsert_partitions(spark, bronze(spark, "oi", oi), root, "oi")
    return root


def test_combined_reader(spark, market_lake):
    got = combined.load_combined(
        spark, market_lake, include_open_interest=True, exchanges=["Deribit"], symbols=["btcusdt"], timeframes=["1M"], instrument_types=["PERP"]
    ).collect()
    assert len(got) == 1 and (got[0].open, got[0].close, got[0].open_interest) == (100.0, 100.5, 123.0)
    assert combined.load_combined(spark, market_lake, limit=1).count() == 1
    assert combined.load_combined(spark, market_lake).columns[:5] == ["exchange", "instrument_type", "symbol", "timeframe", "open_time"]
    with pytest.raises(ValueError):
        combined.load_combined(spark, market_lake, limit=0)
    without = combined.combined_oi_join(combined.load_combined(spark, market_lake), None)
    assert without.where("open_interest is not null").count() == 0


def test_stats_export(spark, market_lake, tmp_path):
    start = datetime(2026, 5, 1, tzinfo=timezone.utc)
    stats = combined.export_stats(spark, market_lake, start, start + timedelta(days=1), symbols=["BTCUSDT"])
    assert {r.Variable: r.Mean for r in stats.collect()} == {"open": 100.0, "high": 110.0, "low": 90.0, "close": 100.5, "volume": 1.0}
    lake.write_stats_csv(stats, str(tmp_path / "csv"))
    lines = next((tmp_path / "csv").glob("*.csv")).read_text().splitlines()
    assert lines[0] == "Variable,Mean,Std,Min,Max" and len(lines) == 6
    for bad in ((start.replace(tzinfo=None), start), (start + timedelta(days=1), start)):
        with pytest.raises(ValueError):
            combined.export_stats(spark, market_lake, *bad)


# ---- manifests and artifacts ----------------------------------------------------------------------


def test_manifests(spark, tmp_path):
    root, kept = str(tmp_path / "lake"), str(tmp_path / "manifests")
    lake.upsert_partitions(spark, bronze(spark, "spot", [candle(f"2026-05-0{d} 00:00:00", 1.0) for d in (1, 2)]), root, "spot")
    stored = lake.scan_lake(spark, root, "spot")
    one_day = manifests.manifest_bronze(stored.where("date = '2026-05-01'"), "spot")
    manifests.write_manifests(one_day, kept)
    shape = "dataset_type string, exchange string, instrument_type string, symbol string, timeframe string, date string"
    known = manifests.read_manifests(spark, kept, shape)
    days = lake.list_partitions(spark, root, "spot")
    assert rows(manifests.missing_manifests(days, known), "date") == [("2026-05-02",)]
    added = manifests.manifests_to_add(days, stored, known, "spot").first()
    payload = {
        "columns": [f.name for f in BRONZE_SCHEMAS["spot"]], "max_timestamp": "2026-05-02T00:00:00Z",
        "min_timestamp": "2026-05-02T00:00:00Z", "rows_out": 1,
    }
    from hashlib import sha256

    text = json.dumps(payload, sort_keys=True, separators=(",", ":"))
    assert added.source_data_hash == sha256(text.encode()).hexdigest()[:12]
    assert json.loads(added.feature_metadata)["open_price"]["null_count"] == 0
    assert manifests.read_manifests(spark, str(tmp_path / "none"), shape) is None


def test_value_checksum_sees_changed_values(spark):
    a = bronze(spark, "spot", [candle("2026-05-01 00:00:00", 1.0), candle("2026-05-01 00:01:00", 2.0)])
    b = bronze(spark, "spot", [candle("2026-05-01 00:01:00", 2.0), candle("2026-05-01 00:00:00", 1.0)])
    c = bronze(spark, "spot", [candle("2026-05-01 00:00:00", 1.5), candle("2026-05-01 00:01:00", 2.0)])
    sums = [manifests.manifest_bronze(lake.with_partitions(x), "spot").first() for x in (a, b, c)]
    assert sums[0].value_checksum == sums[1].value_checksum != sums[2].value_checksum
    assert sums[0].source_data_hash == sums[2].source_data_hash


def test_latest_artifact_prefers_folders_and_new_files(spark):
    old, new = ts("2026-05-01 00:00:00"), ts("2026-05-02 00:00:00")
    listing = spark.createDataFrame(
        [
            ("/l2/exchange=deribit/symbol=BTC-PERPETUAL/version=v1/build_id=a/data.parquet", new),
            ("/l2/exchange=deribit/symbol=BTC_USDC/version=v2/build_id=b/data.parquet", old),
            ("/l2/BTC_L2_x_y.parquet", new),
            ("/l2/sub/ETH_L2_x_y.parquet", old),
            ("/l2/sub/ETH_L2_z_y.parquet", new),
            ("/l2/other.parquet", new),
        ],
        "path string, modificationTime timestamp",
    )
    got = rows(lake.latest_artifact(listing), "exchange", "symbol", "path")
    assert got == [
        ("deribit", "BTC", "/l2/exchange=deribit/symbol=BTC-PERPETUAL/version=v1/build_id=a"),
        (None, "ETH", "/l2/sub/ETH_L2_z_y.parquet"),
    ]


# ---- landed pages and streaming -------------------------------------------------------------------


def pages(spark, *payloads, symbol="BTC-PERPETUAL"):
    made = [(i, symbol, p if isinstance(p, str) else json.dumps(p)) for i, p in enumerate(payloads)]
    return spark.createDataFrame(made, "page_no bigint, symbol string, payload string")


def chart(ticks, close, **extra):
    n = len(ticks)
    return {"result": {"status": "ok", "ticks": ticks, "open": [1.0] * n, "high": [2.0] * n, "low": ["0.5"] * n, "close": close, "volume": [3] * n, **extra}}


def test_ingest_charts(spark, tmp_path):
    landed = pages(spark, chart([0, 60_000], [1.5, 1.6]), chart([60_000], [1.7]), {"result": {"status": "no_data"}})
    root = str(tmp_path / "lake")
    ingest_pages(spark, landed, root, "perp", "r", "2026-05-01")
    stored = lake.scan_lake(spark, root, "perp")
    assert rows(stored, "open_time", "close_time", "close_price", "low_price", "quote_volume", "trade_count") == [
        (ts("1970-01-01 00:00:00"), ts("1970-01-01 00:00:59.999"), 1.5, 0.5, None, 0),
        (ts("1970-01-01 00:01:00"), ts("1970-01-01 00:01:59.999"), 1.7, 0.5, None, 0),
    ]
    assert stored.first().source_endpoint == "public_market_data"
    assert rows(spark.read.json(f"{root}/_manifests"), "date", "rows_out") == [("1970-01-01", 2)]


@pytest.mark.parametrize(
    "payload",
    [chart([0], [1.0], status="error"), chart([0], [1.0, 2.0]), {"result": {"status": "ok", "ticks": [0]}}],
)
def test_bad_charts_fail(spark, payload):
    from tidelake.sources.landing import normalize_klines

    with pytest.raises(Exception, match="chart"):
        normalize_klines(pages(spark, payload), 60_000, "deribit").collect()


def test_funding_items(spark):
    from tidelake.sources.landing import normalize_funding

    items = [
        {"timestamp": 0, "interest_8h": 0.1, "interest_1h": 0.2, "index_price": 5.0, "prev_index_price": None},
        {"timestamp": 1000, "interest_1h": 0.2, "index_price": 5.0, "prev_index_price": 6.0},
        {"timestamp": 2000, "interest_8h": None, "interest_1h": 0.2},
        {"interest_8h": 0.1},
        {"timestamp": 3000},
    ]
    got = normalize_funding(pages(spark, {"result": items}, {"result": None}), "deribit").orderBy("open_time")
    assert [(r.funding_rate, r.index_price, r.mark_price) for r in got.collect()] == [
        (0.1, 5.0, 5.0), (0.2, 5.0, 6.0), (0.0, 0.0, 0.0), (0.0, 0.0, 0.0),
    ]


def test_option_trades(spark):
    from tidelake.sources.landing import PAGE_KEYS, normalize_option_trades, page_dedup

    trades = [
        {"timestamp": 1000, "trade_id": "a", "price": 0.1, "amount": 2, "direction": "BUY", "liquidation": "M", "instrument_name": "BTC-27DEC24-50000-C"},
        {"timestamp": 1000, "trade_id": "a", "amount": 1, "direction": "x", "instrument_name": "BTC-27DEC24-abc-p"},
        {"timestamp": 1000, "trade_id": "a", "price": 0.3, "amount": 5, "instrument_name": "BTC-27DEC24-50000-C"},
    ]
    raw = normalize_option_trades(pages(spark, {"result": {"trades": trades}}, symbol="BTC_USDC"), "deribit")
    got = rows(page_dedup(raw, PAGE_KEYS["option_trades"], 0, 5000), "symbol", "expiry", "strike", "option_type", "price", "side", "is_maker")
    assert got == [("BTC", "27DEC24", 0.0, "put", 0.0, "unknown", False), ("BTC", "27DEC24", 50000.0, "call", 0.3, "unknown", False)]
    assert page_dedup(raw, PAGE_KEYS["option_trades"], 2000, 5000).count() == 0


def test_stream_restarts_and_replays(spark, tmp_path):
    landing, root = str(tmp_path / "landing"), str(tmp_path / "lake")
    first = bronze(spark, "spot", [candle("2026-05-01 00:00:00", 1.0), candle("2026-05-01 00:01:00", 2.0)])
    first.write.parquet(landing)
    chunk_flush(spark, landing, root, "spot", str(tmp_path / "a"))
    more = bronze(spark, "spot", [candle("2026-05-01 00:01:00", 3.0, ingested_at="2026-05-12"), candle("2026-05-02 00:00:00", 4.0)])
    more.write.mode("append").parquet(landing)
    expected = [(ts("2026-05-01 00:00:00"), 1.0), (ts("2026-05-01 00:01:00"), 3.0), (ts("2026-05-02 00:00:00"), 4.0)]
    for checkpoint in ("a", "a", "b"):  # go on, nothing new, replay all under a new checkpoint
        chunk_flush(spark, landing, root, "spot", str(tmp_path / checkpoint))
        assert rows(lake.scan_lake(spark, root, "spot"), "open_time", "close_price") == expected


# ---- landing, times and order ---------------------------------------------------------------------


def pages_of(spark, *payloads):
    return spark.createDataFrame([(i, "BTC-PERPETUAL", p) for i, p in enumerate(payloads)], "page_no long, symbol string, payload string")


TRADE_PAGE = '{"result":{"trades":[%s]}}'


@pytest.mark.parametrize("payload", ["not json at all", '{"error":{"code":1}}', '{"result":{}}', None, ""])
def test_pages_without_their_list_raise(spark, payload):
    from tidelake.sources import landing

    for normalise in (landing.normalize_trades, landing.normalize_oi):
        with pytest.raises(Exception, match="page without"):
            normalise(pages_of(spark, payload), "deribit").collect()


def test_funding_pages(spark):
    from tidelake.sources import landing

    with pytest.raises(Exception, match="page without"):
        landing.normalize_funding(pages_of(spark, "not json"), "deribit").collect()
    assert landing.normalize_funding(pages_of(spark, '{"result":null}', '{"result":7}', "{}"), "deribit").collect() == []


def test_trade_fields_are_cast_strictly(spark):
    from tidelake.sources import landing

    read = lambda item: landing.normalize_trades(pages_of(spark, TRADE_PAGE % item), "deribit").first()
    got = read('{"timestamp":1000,"trade_id":"a","price":"100.5","amount":2}')
    assert (got.price, got.quantity, got.open_time) == (100.5, 2.0, ts("1970-01-01 00:00:01"))
    assert read('{"timestamp":1000}').price == 0.0
    assert read('{"price":1}').open_time == ts("1970-01-01 00:00:00")
    for item in ('{"timestamp":1,"price":"x"}', '{"timestamp":null,"price":1}', '{"timestamp":1,"price":null}', '{"timestamp":"soon"}'):
        with pytest.raises(Exception, match="no number|null"):
            read(item)


def test_rows_without_time_are_refused(spark, tmp_path):
    batch = bronze(spark, "spot", [candle("2026-05-01 00:00:00", 1.0), candle(None, 2.0)])
    with pytest.raises(ValueError, match="1 rows without open_time"):
        lake.upsert_partitions(spark, batch, str(tmp_path / "lake"), "spot")


def test_an_upsert_reads_its_days_only(spark, tmp_path, monkeypatch):
    root, seen = str(tmp_path / "lake"), []
    lake.upsert_partitions(spark, bronze(spark, "spot", [candle(f"2026-05-{d:02d} 00:00:00", 1.0) for d in range(1, 21)]), root, "spot")
    merge = lake.merge_latest
    monkeypatch.setattr(lake, "merge_latest", lambda stored, new: seen.append(stored) or merge(stored, new))
    lake.upsert_partitions(spark, bronze(spark, "spot", [candle("2026-05-07 00:01:00", 2.0)]), root, "spot")
    plan = seen[0]._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan and ">= 2026-05-07)" in plan and "<= 2026-05-07)" in plan
    assert lake.scan_lake(spark, root, "spot").count() == 21


def test_combined_rows_are_in_order(spark, market_lake):
    lake.upsert_partitions(spark, bronze(spark, "perp", [candle(f"2026-05-01 00:0{m}:00", 1.0, "BTCUSDT") for m in (4, 2, 3)]), market_lake, "perp")
    for oi in (False, True):
        got = [tuple(r) for r in combined.load_combined(spark, market_lake, include_open_interest=oi).select(*combined.SORT).collect()]
        assert got == sorted(got) and len(got) == 5
        first = [tuple(r) for r in combined.load_combined(spark, market_lake, limit=3, include_open_interest=oi).select(*combined.SORT).collect()]
        assert first == got[:3]
    start = datetime(2026, 5, 1, tzinfo=timezone.utc)
    stats = combined.export_stats(spark, market_lake, start, start + timedelta(days=1))
    assert "Sort [" not in stats._jdf.queryExecution().optimizedPlan().toString()


def test_a_bronze_lake_holds_the_feeds_asked_for_once(spark, tmp_path):
    from tidelake.catalog.base import Feeds
    from tidelake.catalog.lake import bronze_lake

    made = [(i, f"2024-01-0{1 + i % 3} 00:{i % 60:02d}:20", i % 3, "click" if i % 2 else "view", 5.0, '{"k": 95}') for i in range(60)]
    events = spark.createDataFrame(made, "event_id long, at string, user_id long, event_type string, value double, props string")
    events.select("event_id", F.col("at").cast("timestamp_ntz").alias("ts"), "user_id", "event_type", "value", "props").write.parquet(str(tmp_path / "events.parquet"))
    f = Feeds(spark, str(tmp_path))

    def held(root):
        return {p.name: sorted(str(x) for x in p.rglob("*.parquet")) for p in Path(root).glob("dataset_type=*")}

    root = bronze_lake(f, "spot")
    spot = held(root)
    assert list(spot) == ["dataset_type=spot"]
    assert bronze_lake(Feeds(spark, str(tmp_path)), "spot", "funding", "perp_trades") == root
    assert held(root)["dataset_type=spot"] == spot["dataset_type=spot"]
    assert set(held(root)) == {"dataset_type=spot", "dataset_type=funding", "dataset_type=perp_trades"}
    assert [lake.scan_lake(spark, root, d).count() for d in ("spot", "funding", "perp_trades", "oi")] == [60, 120, 90, 0]
