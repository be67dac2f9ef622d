"""Atomic upserts, listing-based planning and the silver that follows commits."""

from __future__ import annotations

import shutil

import pytest
from conftest import ts
from helpers import bronze, rows
from test_lake import candle

from tidelake.plans.refresh import silver_refresh
from tidelake.schemas import BRONZE_PARTITIONS, BRONZE_PARTITIONS_OLD
from tidelake.sources import atomic, commits, lake, manifests
from tidelake.sources.atomic import upsert_atomic
from tidelake.streaming.flush import chunk_flush

DAYS = ["2026-05-01", "2026-05-02"]


def batch(spark, close, minute=0, days=DAYS, **extra):
    return bronze(spark, "spot", [candle(f"{d} 00:{minute:02d}:00", close, **extra) for d in days])


def closes(spark, root):
    return [r[0] for r in rows(lake.scan_lake(spark, root, "spot"), "close_price")]


def read_rows(df):
    """Rows that the scans of a frame hand on when it is run."""
    spark = df.sparkSession
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df.collect()
        leaves, total = df._jdf.queryExecution().executedPlan().collectLeaves(), 0
        for i in range(leaves.size()):
            metric = leaves.apply(i).metrics().get("numOutputRows")
            if "FileScan" in leaves.apply(i).toString():
                total += metric.get().value()
        return total
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_merges_like_a_plain_upsert(spark, tmp_path):
    root = str(tmp_path / "lake")
    upsert_atomic(spark, batch(spark, 1.0), root, "spot")
    written = upsert_atomic(spark, batch(spark, 2.0, minute=1, days=DAYS[:1]), root, "spot")
    assert rows(written, "date", "rows") == [("2026-05-01", 2)]
    upsert_atomic(spark, batch(spark, 3.0, days=DAYS[1:], ingested_at="2026-05-12"), root, "spot")
    upsert_atomic(spark, batch(spark, 0.5, days=DAYS[:1], ingested_at="2026-01-01"), root, "spot")  # late, older than what is stored
    assert rows(lake.scan_lake(spark, root, "spot"), "date", "close_price") == [(DAYS[0], 1.0), (DAYS[0], 2.0), (DAYS[1], 3.0)]
    assert rows(lake.list_partitions(spark, root, "spot"), "date") == [(d,) for d in DAYS]
    assert rows(lake.latest_open_time(spark, root, "spot"), "open_time") == [(ts("2026-05-02 00:00:00"),)]
    assert commits.replaced_versions(spark, root, "spot").count() == 3
    assert upsert_atomic(spark, batch(spark, 1.0).limit(0), root, "spot").count() == 0
    assert lake.scan_lake(spark, root, "perp").count() == 0


def test_a_reader_meets_old_or_new_days_never_a_mix(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "lake")
    upsert_atomic(spark, batch(spark, 1.0), root, "spot")
    before = lake.scan_lake(spark, root, "spot")
    seen = []
    written = atomic.batch_rows

    def between(*place):
        seen.append(closes(spark, root))  # the days are written, the commit is not
        return written(*place)

    monkeypatch.setattr(atomic, "batch_rows", between)
    upsert_atomic(spark, batch(spark, 2.0, ingested_at="2026-05-12"), root, "spot")
    assert seen == [[1.0, 1.0]]
    assert [r[0] for r in rows(before, "close_price")] == [1.0, 1.0]  # a reader that began earlier goes on with what it saw
    assert closes(spark, root) == [2.0, 2.0]


def test_a_batch_that_died_between_two_days_is_just_run_again(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "lake")
    upsert_atomic(spark, batch(spark, 1.0), root, "spot")
    later = batch(spark, 2.0, ingested_at="2026-05-12")

    def die(spark, root, dataset, commit):
        # only the first day came out
        place = commits.versions_path(root, commit)
        shutil.rmtree(next((tmp_path / "lake" / "_versions").glob(f"batch={commit}/**/date={DAYS[1]}")))
        assert place
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(atomic, "batch_rows", die)
        with pytest.raises(RuntimeError):
            upsert_atomic(spark, later, root, "spot")
    assert closes(spark, root) == [1.0, 1.0]
    upsert_atomic(spark, later, root, "spot")
    assert closes(spark, root) == [2.0, 2.0]


def test_a_known_key_changes_nothing(spark, tmp_path):
    root = str(tmp_path / "lake")
    first = upsert_atomic(spark, batch(spark, 1.0), root, "spot", key="b1")
    again = upsert_atomic(spark, batch(spark, 9.0), root, "spot", key="b1")
    assert rows(first, "date", "rows") == rows(again, "date", "rows")
    assert closes(spark, root) == [1.0, 1.0] and commits.commit_log(spark, root, "spot").select("commit").distinct().count() == 1


def test_plain_days_of_both_layouts_move_when_touched(spark, tmp_path):
    root = str(tmp_path / "lake")
    plain = lake.with_partitions(batch(spark, 1.0, days=[*DAYS, "2026-05-03"]))
    plain.where("date <> '2026-05-02'").write.mode("append").partitionBy(*BRONZE_PARTITIONS).parquet(root)
    plain.where("date = '2026-05-02'").drop("year").write.mode("append").partitionBy(*BRONZE_PARTITIONS_OLD).parquet(root)
    upsert_atomic(spark, batch(spark, 2.0, minute=1), root, "spot")
    stored = [(DAYS[0], 1.0), (DAYS[0], 2.0), (DAYS[1], 1.0), (DAYS[1], 2.0), ("2026-05-03", 1.0)]
    assert rows(lake.scan_lake(spark, root, "spot"), "date", "close_price") == stored
    assert lake.scan_lake(spark, root, "spot", symbol="ETH_USDC").count() == 0
    assert lake.scan_lake(spark, root, "spot", months="2026-05").count() == 5
    assert rows(lake.list_partitions(spark, root, "spot"), "date") == [(d,) for d in (*DAYS, "2026-05-03")]


def test_rows_without_time_are_refused(spark, tmp_path):
    with pytest.raises(ValueError, match="1 rows without open_time"):
        upsert_atomic(spark, bronze(spark, "spot", [candle(None, 2.0)]), str(tmp_path / "lake"), "spot")


def test_reads_are_those_of_the_days_in_question(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "lake")
    month = [f"2026-05-{d:02d}" for d in range(1, 21)]
    for close in (1.0, 2.0):  # two versions of each day
        upsert_atomic(spark, batch(spark, close, days=month, ingested_at=f"2026-06-0{int(close)}"), root, "spot")
    upsert_atomic(spark, bronze(spark, "spot", [candle(f"{d} 00:00:00", 5.0, "ETH_USDC") for d in month[:9]]), root, "spot")
    assert closes(spark, root) == [2.0] * 20 + [5.0] * 9
    log_rows = 49
    # Of the replaced versions no row is read.
    assert read_rows(lake.scan_lake(spark, root, "spot").select("close_price")) <= 29 + 2 * log_rows
    # The last day of each symbol, and those of the other symbol on the same dates.
    latest = lake.last_days(spark, root, "spot")
    assert rows(latest, "symbol", "date") == [("BTC_USDC", "2026-05-20"), ("ETH_USDC", "2026-05-09")]
    assert read_rows(latest.select("open_time")) <= 3 + 2 * log_rows + 2
    seen = []
    merge = lake.merge_latest
    monkeypatch.setattr(lake, "merge_latest", lambda stored, new: seen.append(stored) or merge(stored, new))
    upsert_atomic(spark, batch(spark, 3.0, minute=7, days=["2026-05-07"]), root, "spot")
    assert rows(seen[0], "date", "close_price") == [("2026-05-07", 2.0)]
    assert read_rows(seen[0]) <= 2 + 2


def test_missing_manifests_opens_no_data_file(spark, tmp_path):
    root = str(tmp_path / "lake")
    plain = lake.with_partitions(batch(spark, 1.0))
    plain.write.mode("append").partitionBy(*BRONZE_PARTITIONS).parquet(root)
    for file in (tmp_path / "lake").rglob("*.parquet"):
        file.write_bytes(b"no parquet at all")
    known = spark.createDataFrame([("spot", "deribit", "spot", "BTC_USDC", "1m", DAYS[0])], "dataset_type string, exchange string, instrument_type string, symbol string, timeframe string, date string")
    assert rows(manifests.missing_manifests(lake.list_partitions(spark, root, "spot"), known), "date") == [(DAYS[1],)]


def test_manifests_are_appended_once(spark, tmp_path):
    root = str(tmp_path / "lake")
    shape = "date string, rows_out bigint, commit string"
    upsert_atomic(spark, batch(spark, 1.0), root, "spot")
    assert [atomic.add_commit_manifests(spark, root, "spot") for _ in range(2)] == [1, 0]
    upsert_atomic(spark, batch(spark, 2.0, minute=1, days=DAYS[:1]), root, "spot")
    upsert_atomic(spark, batch(spark, 2.0, minute=2, days=DAYS[:1]), root, "spot")
    assert atomic.add_commit_manifests(spark, root, "spot") == 2
    assert rows(manifests.read_manifests(spark, f"{root}/_manifests", shape), "date", "rows_out") == [(DAYS[0], 1), (DAYS[0], 2), (DAYS[0], 3), (DAYS[1], 1)]


def test_a_stream_describes_its_commits(spark, tmp_path):
    landing, root = str(tmp_path / "landing"), str(tmp_path / "lake")
    batch(spark, 1.0).write.parquet(landing)
    for _ in range(2):
        chunk_flush(spark, landing, root, "spot", str(tmp_path / "a"))
    assert rows(manifests.read_manifests(spark, f"{root}/_manifests", "date string, rows_out bigint"), "date", "rows_out") == [(d, 1) for d in DAYS]
    # The streaming log lost its note of the batch: the key in the commit log is enough.
    shutil.rmtree(tmp_path / "a" / "commits")
    chunk_flush(spark, landing, root, "spot", str(tmp_path / "a"))
    assert commits.commit_log(spark, root, "spot").select("commit").distinct().count() == 1


def test_silver_follows_commits(spark, tmp_path):
    bronze_root, silver_root = str(tmp_path / "bronze"), str(tmp_path / "silver")

    def refreshed():
        return rows(silver_refresh(spark, bronze_root, silver_root, "spot", "2026-06-01"), "symbol", "month")

    def stored():
        return rows(lake.read_silver(spark, silver_root, "spot", "1m"), "symbol", "month", "close_price")

    assert refreshed() == []
    months = ["2026-04-30", "2026-05-01"]
    upsert_atomic(spark, batch(spark, 100.0, days=months), bronze_root, "spot")
    upsert_atomic(spark, bronze(spark, "spot", [candle("2026-05-01 00:00:00", 105.0, "ETH_USDC")]), bronze_root, "spot")
    assert refreshed() == [("BTC", "2026-04"), ("BTC", "2026-05"), ("ETH", "2026-05")]
    before = {p: p.stat().st_mtime_ns for p in (tmp_path / "silver").rglob("*.parquet")}
    assert refreshed() == []
    upsert_atomic(spark, batch(spark, 101.0, days=months[1:], ingested_at="2026-05-12"), bronze_root, "spot")
    upsert_atomic(spark, batch(spark, 102.0, minute=1, days=months[1:]), bronze_root, "spot")
    assert refreshed() == [("BTC", "2026-05")]
    assert stored() == [("BTC_USDC", "2026-04", 100.0), ("BTC_USDC", "2026-05", 101.0), ("BTC_USDC", "2026-05", 102.0), ("ETH_USDC", "2026-05", 105.0)]
    # The files of the other months and symbols are the ones of the first refresh.
    kept = [p for p in before if "_progress" not in str(p) and p.exists() and p.stat().st_mtime_ns == before[p]]
    assert len(kept) == 2


def test_refreshed_features_equal_a_whole_build(spark, tmp_path):
    from tidelake.plans.silver import build_silver

    def ticks(days, price, exchange="Deribit"):
        return bronze(spark, "perp_trades", [
            {"open_time": f"{d} 00:0{m}:30", "ingested_at": "2026-06-01", "trade_id": f"{d}-{m}", "price": price + m, "quantity": 2.0, "side": "buy", "symbol": "BTC-PERPETUAL", "exchange": exchange}
            for d in days for m in range(3)
        ], timeframe="tick")

    bronze_root = str(tmp_path / "bronze")
    for part in (ticks(["2026-04-30", "2026-05-01"], 10.0), ticks(["2026-05-02"], 20.0, "DERIBIT")):
        upsert_atomic(spark, part, bronze_root, "perp_trades")
        silver_refresh(spark, bronze_root, str(tmp_path / "followed"), "perp_trades", "2026-06-02")
    build_silver(spark, bronze_root, str(tmp_path / "whole"), "perp_trades", "2026-06-02")
    for table, frame in (("perp_trades_observed", "tick"), ("perp_trades_1m_feature", "1m")):
        followed, whole = (rows(lake.read_silver(spark, str(tmp_path / name), table, frame)) for name in ("followed", "whole"))
        assert followed == whole and len(whole) == 9
