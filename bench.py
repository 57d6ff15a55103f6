"""Benchmark: median of 3 runs per headline query on the bound test tables.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_RUNS (default 3), BENCH_QUERIES ("headline" default, "all", or a comma list),
BENCH_EVENTLOG_DIR (optional: write Spark's event log there for stage timings).
Each run builds the query, derives the canonical tables it uses from the given files,
and executes it completely into Spark's no-op sink (nothing is collected to the driver):
a key's time under "queries" is all it costs. Under "stored" are the times of the same keys on
tables that were derived and stored once, which took "load_sec" (BENCH_STORED=0 leaves that out).
Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from recurra.plans import registry as plans_registry  # noqa: E402
from recurra.plans.registry import all_queries  # noqa: E402
from recurra.session import local_session  # noqa: E402
from recurra.sources.load import LOAD_SECONDS, load_model  # noqa: E402

HEADLINE = [
    "q01_scorecard", "q02_mrr_mom", "q03_logo_churn", "q04_expansion", "q05_ltv_cac",
    "q06_ltv_deciles", "q07_cohort_counts", "q08_tier_metrics", "q09_churn_warning", "q10_nrr",
    "q11_rolling7", "q12_outliers", "q13_nulls", "q14_dup_payments", "q15_segment_ltv",
    "q16_churn_reasons", "q17_sla", "q18_sla_trend", "q19_arr_forecast", "q20_size_tenure",
    "q21_decline_rate", "q22_region_matrix", "k1_monthly_records", "k2_quality_profile",
    "k3_mom_growth", "cln_generic", "aud_fk", "aud_not_null", "val_dup_rows",
    "kpi_monthly_snapshot", "kpi_monthly_paid", "d04_mrr_growth", "d06_nrr_12m",
    "n3_feature_matrix", "n3_describe", "n5_cohort_matrix", "gen_billing_schedule",
    "x_retry_recovery", "d_cards_contexts", "d04_mrr_growth_by_plan", "d06_d07_by_region",
    "kpi_distinct_rollup", "iv_activity_within", "iv_plan_overlaps", "n5_auc_exact",
]
#: Keys of the first two rounds: their sum is what earlier rounds' "value" was.
EARLIER = HEADLINE[:-7]


def timed(keys: list[str], runs: int, registry: dict, spark, sf_dir: str) -> dict[str, float]:
    times: dict[str, float] = {}
    for key in keys:
        samples = []
        for _ in range(runs):
            t0 = time.perf_counter()
            registry[key](spark, sf_dir).write.format("noop").mode("overwrite").save()
            samples.append(time.perf_counter() - t0)
        times[key] = round(statistics.median(samples), 3)
    return times


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    pick = os.environ.get("BENCH_QUERIES", "headline")
    extra = {}
    if os.environ.get("BENCH_EVENTLOG_DIR"):     # stage/task timings for later reading
        extra = {"spark.eventLog.enabled": "true",
                 "spark.eventLog.dir": os.environ["BENCH_EVENTLOG_DIR"]}
    spark = local_session(cores=cpus, shuffle_partitions=max(8, 2 * cpus), app="recurra-bench",
                          extra_conf=extra)
    registry = all_queries()
    if pick == "all":
        keys = list(registry)
    elif pick == "headline":
        keys = HEADLINE
    else:
        keys = [k.strip() for k in pick.split(",") if k.strip()]
    times = timed(keys, runs, registry, spark, sf_dir)
    extra_out = {}
    if os.environ.get("BENCH_STORED", "1") != "0":
        plans_registry.model = load_model                 # from here on keys read stored tables
        load_model(spark, sf_dir)
        extra_out = {"load_sec": round(LOAD_SECONDS[sf_dir], 3), "stored": timed(keys, runs, registry, spark, sf_dir)}
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "sum_of_median_query_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else sf_dir,
        "runs": runs,
        "cpus": cpus,
        "value_of_earlier_keys": round(sum(times.get(k, 0.0) for k in EARLIER), 3),
        **extra_out,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
