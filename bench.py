"""Time the headline queries; prints one JSON line.

Settings: BENCH_SF_DIR (tables), BENCH_CPUS (local cores), BENCH_RUNS (timed runs after one
warm-up) and BENCH_QUERIES (comma-separated names, default: the headline list).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from tabloom import runtime
from tabloom.plans.catalog import all_queries

HEADLINE = (
    "accuracy_by_weekday",
    "melt_devices",
    "month_length_features",
    "cyclic_error",
    "hash_split",
    "exact_split",
    "stratified_folds",
    "hash_rank",
    "describe_lines",
    "box_stats_orders",
    "standard_scale",
    "roc_points",
    "binary_report",
    "tokenize",
    "build_vocab",
    "encode_corpus",
    "training_pairs",
    "permutation_importance",
    "partial_dependence",
    "weekend_forest_by_day",
    "balanced_logit",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    chosen = os.environ.get("BENCH_QUERIES")
    catalog = all_queries()
    names = list(catalog) if chosen == "all" else chosen.split(",") if chosen else list(HEADLINE)
    spark = runtime.session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": str(cpus),
            "spark.driver.memory": "16g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds: dict[str, float] = {}
    for name in names:
        timings = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            catalog[name].run(spark, folder).write.format("noop").mode("overwrite").save()
            timings.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(timings[1:]), 3)
        if os.environ.get("BENCH_VERBOSE"):
            print(name, seconds[name], file=sys.stderr, flush=True)
    result = {
        "metric": "headline_queries_total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": folder.rstrip("/").rsplit("sf", 1)[-1],
    }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
