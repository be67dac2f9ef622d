"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the data folder, ``BENCH_CPUS`` the number of local cores. Each query is run once to warm up
(this also writes the silver tables that the gold queries read) and once for the record, into a sink that drops rows.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidelake.catalog import QUERIES  # noqa: E402
from tidelake.session import lake_session  # noqa: E402

HEADLINE = [
    "trade_bars_1m",
    "trade_bars_large",
    "ohlcv_clean",
    "silver_report_ohlcv",
    "trades_observed",
    "funding_observed",
    "asof_funding_1m",
    "asof_oi_1m",
    "month_carry_reset",
    "gold_core",
    "grid_left_join",
    "gold_hybrid_lenient",
    "feature_metadata",
    "profile_stats",
    "histogram_24",
    "even_sample",
    "gap_ranges_candles",
    "full_gap_fill",
    "tail_delta",
    "price_direction",
    "descriptive_stats",
    "combined_oi_join",
    "load_combined",
    "normalize_klines",
    "contract_drift",
    "semver_timeline",
    "manifest_bronze",
    "upsert_partitions",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = lake_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.driver.memory": "16g",
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - start, 3)

    seconds = {}
    for name in names:
        run(name)
        seconds[name] = run(name)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        ),
        flush=True,
    )
    spark.stop()


if __name__ == "__main__":
    main()
