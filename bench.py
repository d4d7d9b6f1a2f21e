"""Time the headline queries: one warm-up, then the median of three runs. Prints one JSON line.

BENCH_SF_DIR names the scale folder, BENCH_CPUS the number of local cores, BENCH_ALL=1 times every
query once.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

import pyspark
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).parent))
import catalog  # noqa: E402

HEADLINE = [
    "screen_chain", "branch_scaled",
    "filter_rows_sum_gt", "filter_rows_sum_gt_quantile", "filter_rows_var_gt",
    "filter_rows_col_gt_quantile", "filter_rows_group_func_ge", "filter_rows_group_mad",
    "transform_cpm", "transform_log2p", "transform_zscore_columns", "transform_zscore_rows",
    "pivot_wide", "transpose_data", "aggregate_duplicate_rows_sum",
    "aggregate_duplicate_rows_median", "aggregate_sets_mean", "map_ids_collapse", "training_set",
    "column_correlations", "cross_cor_columns", "filter_rows_max_correlation",
    "project_pca_columns", "impute_knn", "knn_graph", "cluster_hclust", "profile_values",
    "profile_row_median", "profile_column_median", "sample_rows",
]


def run(query, spark: SparkSession, sf: str) -> float:
    start = time.perf_counter()
    query(spark, sf).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (SparkSession.builder.master(f"local[{cpus}]").appName("bench")
             .config("spark.sql.shuffle.partitions", cpus).config("spark.driver.memory", "16g")
             .config("spark.ui.enabled", "false").config("spark.sql.session.timeZone", "UTC")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    whole = os.environ.get("BENCH_ALL") == "1"
    times: dict[str, float] = {}
    for name in (catalog.QUERIES if whole else HEADLINE):
        query = catalog.QUERIES[name]
        runs = [run(query, spark, sf) for _ in range(1 if whole else 4)]
        times[name] = round(statistics.median(runs[1:] or runs), 3)
        print(f"{name} {times[name]}", file=sys.stderr)
    print(json.dumps({
        "metric": "total_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": Path(sf).name, "cpus": int(cpus), "spark": pyspark.__version__}))


if __name__ == "__main__":
    main()
