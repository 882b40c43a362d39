"""Benchmark the headline queries.

Runs each query at ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) on
``local[$BENCH_CPUS]`` and prints one JSON line.  Each query is fully
executed through the ``noop`` sink (no driver collect); the reported time per
query is the median of ``$BENCH_RUNS`` runs (default 3; one for the dear
queries), after one warm-up of the flagship query.  ``value`` is the sum over
the headline queries; ``dear_total`` that over the dear ones.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "customer_features",
    "rfm",
    "event_stats",
    "ticket_stats",
    "basic_activity_stats",
    "churn_rate_by_plan_type",
    "churn_rate_by_age_group",
    "kpi_overview",
    "value_counts_payment_method",
    "monthly_volume_transactions",
    "avg_amount_by_plan",
    "describe_clv",
    "histogram_amount",
    "boxplot_amount_by_payment",
    "correlation_matrix",
    "stratified_split",
    "standardize",
    "roc_auc",
    "roc_curve",
    "classification_report",
    "regression_metrics",
    "assign_segment",
    "segment_summary",
    "risk_flags",
    "inactive_customers",
    "high_value_profile",
]
# Model and segmentation queries: dear, so run once each (no warm-up run).
DEAR = [
    "compare_models_regression",
    "compare_models_classification",
    "kmeans_segments",
    "elbow",
    "pca_2d",
    "daily_churn_scoring",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = [n for n in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE + DEAR)).split(",") if n]

    from stayrate.plans import QUERIES
    from stayrate.session import get_spark

    spark = get_spark(f"local[{cpus}]", int(cpus) * 2)

    def run(name: str) -> float:
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    run("customer_features")                     # JVM / codegen warm-up
    timings = {}
    for name in names:
        once = name in DEAR
        timings[name] = round(statistics.median(run(name) for _ in range(1 if once else runs)), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    dear = sum(t for n, t in timings.items() if n in DEAR)
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(timings.values()) - dear, 3),
                      "dear_total": round(dear, 3),
                      "unit": "sec", "queries": timings, "sf": sf, "runs": runs,
                      "cpus": int(cpus)}))
    spark.stop()


if __name__ == "__main__":
    main()
