"""Headline queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``; prints one JSON line.

Each query is run to completion with a noop write (all rows and columns are computed, nothing is
collected). The best of ``$BENCH_RUNS`` runs counts, after one warm-up of the session.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidemark.session import build_session  # noqa: E402
from tidemark.testbed.catalog import QUERIES  # noqa: E402

HEADLINE = [
    "a05_regulatory_reconciliation",
    "a03_financial_performance",
    "a04_customer_risk",
    "a06_batch_trade_performance",
    "a11_account_balances",
    "a15_customer_summary",
    "a16_account_activity",
    "p08_fact_trade",
    "p24_fct_transactions",
    "p26_high_risk_transactions",
    "a02_customer_trade_exposure",
    "a20_stage_counts",
    "w01_latest_per_key",
    "m02_m08_bank_transactions",
    "m22_daily_account_balances",
    "q07_suite_trades",
    "q16_equality_with_precision",
    "q19_ranges_gaps_allowed",
    "q26_sequential_values",
    "r06_reconciliation_result",
    "r07_scd2_snapshot",
    "a22_pivot",
    "u06_unpivot",
    "f09_f11_url_parts",
    "k05_upsert_latest",
    "k03_t05_foreach_batch_fan_out",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    chosen = os.environ.get("BENCH_QUERIES")
    names = chosen.split(",") if chosen else HEADLINE
    partitions = "8" if cpus == "*" else cpus
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": partitions,
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "12g"),
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1000).selectExpr("sum(id)").collect()
    seconds: dict[str, float] = {}
    for name in names:
        times = []
        for _ in range(runs):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[name] = round(min(times), 3)
    spark.stop()
    print(json.dumps({
        "metric": "headline_queries_total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
