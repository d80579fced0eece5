"""Headline queries at one scale factor; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8), BENCH_RUNS (default 3).
Each query runs once to warm up; the median of the following runs is reported. A run
covers building the DataFrame, planning it and writing every row to a no-op sink.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = (
    "c18_all_checks", "a08_full_run", "a09_score_history", "q05_top_issues", "k01_latest_category", "k03_clean", "s04_exact_sample",
    "g05_control_tests", "g05b_rulebook_row_rules", "rule_accu007_gl_balance_accuracy", "rule_cons002_transaction_account_consistency",
    "rule_time002_transaction_feed_sla", "rule_time007_risk_report_delivery_sla",
    "x04_exceptions", "w07b_watchlist_table", "w12_watchlist_history", "t05_trust_with_enterprise", "t06_maturity",
    "r03_sla_tracking", "r05_breach_by_severity", "r06_resolution_time", "r10_failure_streaks", "r15_tiered_sla",
    "d21_scorecard", "d26_daily_pass_rate", "d35_co_failures", "m01_review_scalars",
)


def main() -> None:
    from plumbline.session import build_session
    from registry import QUERIES

    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = build_session(
        f"local[{cpus}]", app="bench", spark__sql__shuffle__partitions=cpus, spark__ui__enabled="false", spark__driver__memory="8g",
        spark__ui__showConsoleProgress="false")
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in HEADLINE:
        taken = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - start)
        times[name] = round(statistics.median(taken[1:]), 3)
    spark.stop()
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
        "sf": os.path.basename(sf.rstrip("/")).removeprefix("sf")}))


if __name__ == "__main__":
    main()
