"""Benchmark the headline queries.

Runs each query on ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) with
``local[$BENCH_CPUS]`` and prints ONE JSON line. Every timing executes the
whole plan through the ``noop`` sink (all rows produced, nothing written), in a
warm session, as the median of ``$BENCH_REPEAT`` runs (default 3).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tessera.plans import catalog  # noqa: E402
from tessera.session import get_session  # noqa: E402

HEADLINE = [
    "l3_train",            # full flow: clean → engineer → split → fit → select → OLS → metrics
    "l4_score_batch",      # train + batch scoring of every row
    "f6_clean",            # cleaning chain incl. group-mean imputation
    "p3_describe_numeric_nulls",  # exact quartiles + moments
    "p1_duplicate_rows",   # duplicate count over lineitem
    "p8_column_info",      # schema snapshot with counts
    "m4_column_transform", # fit on train + transform all
    "m8_f_scores",         # one-pass F-scores
    "w1_group_mean_impute",
    "r5_metrics_by_split",
    "v8_record_contract",  # JSON record parsing
    "s5_null_tokens",      # text → typed with null tokens
    "l2_data_stage",       # CSV → checked, counted and written in one pass → profiles
    "l4_stream_rows",      # scoring stream alone, with a given model
    "k10_predictions",     # batch scoring alone, with a given model
    "m13_wide_onehot",     # least squares with a one-hot column per customer
    "p1_duplicate_documents",  # whole texts, by row digest
    "j2_align_strict",     # pairs and side counts in one exchange
]


def run_once(spark, name: str, sf_dir: str) -> float:
    t0 = time.perf_counter()
    df = catalog.QUERIES[name](spark, sf_dir)
    df.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    names = sys.argv[1:] or HEADLINE
    spark = get_session(f"local[{cpus}]", app_name="tessera-bench", shuffle_partitions=int(cpus), extra={
        "spark.driver.memory": "16g", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"})
    # Warm-up: JVM, parquet footers, codegen caches.
    run_once(spark, "p8_shape", sf_dir)
    timings = {}
    for name in names:
        runs = [run_once(spark, name, sf_dir) for _ in range(repeat)]
        timings[name] = round(statistics.median(runs), 3)
    sf = sf_dir.rsplit("sf", 1)[-1]
    try:
        sf_val: float | str = float(sf)
    except ValueError:
        sf_val = sf
    print(json.dumps({
        "metric": "sum_of_median_query_seconds",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": sf_val,
        "cpus": int(cpus),
        "repeat": repeat,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
