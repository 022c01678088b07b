"""Benchmark: derive the ledger once, then time the headline queries.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Prints one JSON line.  ``value`` is the sum of the per-query medians (3 timed
runs after one warm-up); each run executes the whole plan into Spark's ``noop``
sink, so nothing is collected to the driver.  Deriving the ledger (journal,
masters, roll-ups, written as Parquet) is timed separately as ``derive_sec``.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

HEADLINE = [
    # statements and tools
    "income_statement", "income_statement_by_account", "pnl_by_section", "trial_balance", "balance_sheet",
    "branch_balance_check", "departmental_pnl", "structured_income_statement", "cash_flow_indirect",
    "yoy_comparison", "alias_rollup", "account_activity", "monthly_trend", "period_coverage",
    "unclosed_monthly_pnl", "sales_and_gross", "ratios",
    # operators over the full journal
    "journal_to_period", "running_balance", "full_outer_reconcile", "period_shift", "mom_variance",
    "trailing_anomaly", "rolling_12m", "dept_branch_matrix", "subtotals", "late_postings",
    # reconciliation and quality
    "recon_drift", "recon_dept_glcal", "recon_glfis_glcal", "one_sided_journals", "duplicate_keys",
    "period_completeness", "subledger_coverage",
    # ingest
    "merge_upsert", "capture_snapshot", "load_status",
    # extensions
    "aging", "parts_margin", "vendor_patterns",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    partitions = int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", str(max(8, 2 * cpus))))
    from ledgerlake.session import local_session
    spark = local_session(cpus, shuffle_partitions=partitions, app="ledgerlake-bench")
    from ledgerlake import catalog
    from ledgerlake.sources import store

    # Engine warm-up (JIT, code generation caches) on the smallest data set, so
    # the timed derivation measures steady-state work.
    warm = os.environ.get("BENCH_WARMUP_DIR", "/root/testdata/sf0.001")
    if os.path.isdir(warm) and os.path.abspath(warm) != os.path.abspath(sf_dir):
        store.ledger(spark, warm, rebuild=True)
    t = time.time()
    led = store.ledger(spark, sf_dir, rebuild=True)
    derive = time.time() - t

    keys = [k for k in os.environ.get("BENCH_QUERIES", "").split(",") if k] or HEADLINE
    qs = catalog.queries()
    times: dict[str, float] = {}
    failed: dict[str, str] = {}
    for k in keys:
        try:
            samples = []
            for i in range(runs + 1):
                t = time.time()
                qs[k](spark, sf_dir).write.format("noop").mode("overwrite").save()
                if i:
                    samples.append(time.time() - t)
            times[k] = round(statistics.median(samples), 3)
        except Exception as e:  # keep going; report the failure
            failed[k] = f"{type(e).__name__}: {str(e)[:200]}"
    sf = os.path.basename(sf_dir).replace("sf", "")
    out = {
        "metric": "sum_of_median_query_sec",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
        "derive_sec": round(derive, 3),
        "derive_tables_sec": {k: round(v, 3) for k, v in led.build_seconds.items()},
        "cores": cpus,
        "shuffle_partitions": partitions,
        "spark": spark.version,
        "runs": runs,
    }
    if failed:
        out["failed"] = failed
    print(json.dumps(out), flush=True)


if __name__ == "__main__":
    main()
