"""Time the headline queries; prints one JSON line.

    BENCH_SF_DIR  folder of the Parquet tables (default /root/testdata/sf0.1)
    BENCH_CPUS    local cores (default 8)
    BENCH_RUNS    timed runs per query after one warm-up run (default 2); the best counts
    BENCH_ONLY    comma-separated query names, instead of the headline list
"""

import json
import os
import re
import time

from keelmark.session import local_session
from parity import QUERIES

HEADLINE = (
    "churn_product_v1", "churn_product_v2", "customer_features", "transaction_metrics", "src_product_snapshots",
    "balance_trend_90d", "date_spine_activity", "contract_suite", "dq_expectations", "validation_suite", "quality_gate",
    "backward_compat_diff", "incremental_upsert", "referential_integrity", "dq_duplicate_count",
    "tier_distribution", "critical_top50", "intervention_queue", "usage_by_role", "usage_daily",
    "row_count_stability", "health_summary", "retention_expired", "erasure_applied", "json_path_listing", "stream_metrics",
)


def seconds(spark, name: str, folder: str) -> float:
    started = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    names = os.environ["BENCH_ONLY"].split(",") if os.environ.get("BENCH_ONLY") else HEADLINE
    spark = local_session(cpus, "keelmark-bench", shuffle_partitions=cpus)
    spark.sparkContext.setLogLevel("ERROR")
    timed, cold = {}, {}
    for name in names:
        cold[name] = round(seconds(spark, name, folder), 3)
        timed[name] = round(min(seconds(spark, name, folder) for _ in range(runs)), 3)
    scale = re.search(r"sf([\d.]+)", folder)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(timed.values()), 3), "unit": "sec",
        "queries": timed, "sf": float(scale.group(1)) if scale else None, "cold": cold, "cpus": cpus,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
