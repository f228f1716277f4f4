"""Time the headline queries and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose data and cores. Every query is
built and fully computed (written to the no-op sink); the second of two runs counts unless BENCH_RUNS=1.
"""

from __future__ import annotations

import json
import os
import sys
import time

HEADLINE = [
    "campaign_report", "dau_mau", "retention_nday", "growth_accounting", "sessionize", "session_daily_activity", "asof_validity", "attempts_to_first_win",
    "level_mart", "paired_event_fact", "ledger_balance", "ledger_balance_history", "ledger_daily_dense", "counterparty_transactions", "current_balance",
    "deduplicate", "win_running_sum", "win_rank", "validity_ranges", "full_join_zero_fill", "agg_median_percentile", "win_partition_agg", "win_global_rank",
    "cost_revenue_rollup", "roas_by_channel", "cohort_ltv", "cost_allocation", "reconcile_two_sources", "trailing_bound", "check_mutually_exclusive_ranges",
    "check_unique_combination", "expect_agg_between", "expect_within_n_moving_stdevs", "run_checks", "symmetric_diff", "date_dimension", "html_field_extract",
    "incremental_merge_upsert", "incremental_insert_overwrite", "stream_burst_window",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    picks = sys.argv[1:] or HEADLINE

    from tidemark.plans import load_all
    from tidemark.session import local_session

    spark = local_session(cpus, app="tidemark-bench")
    registry = load_all()
    times = {}
    if picks == ["all"]:
        picks = list(registry)
    for name in ("dau_mau", "reconcile"):  # warm-up, not timed
        registry[name].run(spark, sf_dir).write.format("noop").mode("overwrite").save()
    for name in picks:
        for _ in range(runs):
            started = time.perf_counter()
            registry[name].run(spark, sf_dir).write.format("noop").mode("overwrite").save()
            times[name] = round(time.perf_counter() - started, 3)
    print(json.dumps({
        "metric": "tidemark_headline_queries_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
        "cpus": cpus,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
