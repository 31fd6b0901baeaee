"""Time the headline queries; prints one JSON line.

Reads $BENCH_SF_DIR (default /root/testdata/sf0.1) on local[$BENCH_CPUS]. Every query is built
and run in full (all columns of all rows, into a sink that discards them).
"""

from __future__ import annotations

import json
import os
import sys
import time

from bankspark.checks.all import QUERIES
from bankspark.plans.build import build
from bankspark.session import local_session, work_dir
from bankspark.sources import standin

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
HEADLINE = (
    "stg_transactions", "dedup_latest", "enrich_transactions", "fx_as_of", "revenue_monthly",
    "branch_performance", "quarterly_kpis", "customer_profitability", "loan_portfolio",
    "loan_balances_daily", "rapid_fire_events", "fraud_indicators", "customer_360",
    "snapshot_scd2", "apply_changes", "fct_incremental", "dq_suite", "cdc_stream",
)


def main() -> None:
    spark = local_session(CPUS, "bench")
    QUERIES["row_counts"](spark, SF_DIR).collect()  # start the JVM's compilers and file caches
    seconds: dict[str, float] = {}
    for name in HEADLINE:
        t0 = time.monotonic()
        QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.monotonic() - t0, 3)
        print(f"{name}: {seconds[name]}", file=sys.stderr, flush=True)
    t0 = time.monotonic()
    build(
        spark, standin.raw_tables(spark, SF_DIR), standin.exchange_rates(spark),
        work_dir(spark, "build"), standin.BANK, gate=False,
    )
    seconds["batch_build"] = round(time.monotonic() - t0, 3)
    sf = os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "headline queries, total wall time",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
            }
        )
    )


if __name__ == "__main__":
    main()
