"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR names the folder of tables, BENCH_CPUS the local cores.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

HEADLINE = [
    "nation_month_panel", "customer_year_panel", "user_day_panel", "region_period_stats",
    "evolution_summary", "fold_outer_join", "wide_to_long", "coverage_filter", "iqr_filter",
    "lag_gap_aware", "latest_delta", "impute_window_median", "impute_sequential", "forward_fill",
    "contiguous_folds", "describe", "corr_matrix", "histogram", "box_summary", "kde",
    "regression_metrics", "error_stats", "leaderboard", "knn_regress", "elastic_net",
    "random_forest", "gradient_boosting", "svr", "mlp", "cv_fold_scores", "search_grid",
    "fe_two_way", "dynamic_panel_unbalanced", "panel_diagnostics",
]


def main() -> None:
    from panelkit.plans.catalog import QUERIES

    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("panelkit-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    names = sys.argv[1:] or HEADLINE
    spark.read.parquet(f"{folder}/orders.parquet").count()  # start the session's executors
    timings = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        timings[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": os.path.basename(folder.rstrip("/")),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
