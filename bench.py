"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from riskframe.plans.queries import all_queries  # noqa: E402
from riskframe.session import local_session, release  # noqa: E402

HEADLINE = [
    "best_threshold", "cost_curve", "evaluate_scores", "contract_report", "stratified_split",
    "split_overview", "slice_metrics", "worst_slices", "drift_table", "drift_verdict",
    "scenario_table", "describe_numeric", "quantile_bands", "class_histogram",
    "correlation_matrix", "column_profile", "bootstrap_ci", "final_evaluation", "run_ledger",
    "batch_predictions", "log_daily_stats", "log_counters", "explode_batches", "stream_scored",
    "logreg_metrics",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = local_session(cores, int(cores) if cores.isdigit() else 8)
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{folder}/lineitem.parquet").count()  # start the executors
    times = {}
    for name in names:
        start = time.perf_counter()
        all_queries()[name](spark, folder).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
        release(spark)
    print(json.dumps({
        "metric": "headline_queries_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(folder.rstrip("/")),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
