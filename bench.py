"""Time the headline queries and print one JSON line.

Each query runs once to warm up and then three times, the headline five times; its
time is the median. The headline value is ``five_aggregates``: mean length,
positive texts, the top word counts, the top lengths and the length categories
of all documents.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from pyspark.sql import DataFrame, SparkSession

from proseledger.plans.registry import QUERIES

HEADLINE = "five_aggregates"
NAMES = [
    "average_length", "positive_count", "top_word_counts", "top_lengths", "length_categories",
    HEADLINE, "sentiment_summary", "text_features", "word_frequency",
    "extract_features", "extraction_stats", "mask_cards",
    "running_sum", "moving_avg_3", "lag_lead_change", "rank_in_group", "window_report",
    "running_sum_large_groups", "rank_in_group_large_groups", "moving_avg_3_large_groups",
    "lag_lead_change_large_groups", "share_of_total_many_groups", "profile_report",
    "share_of_total", "share_of_total_join", "order_summary",
    "basic_summary", "profile", "correlations", "quantile_histogram", "mode_category",
    "mixed_stats", "sentiment_category", "reconcile_udf_builtin",
    "quantiles_selected", "typed_order_statistics", "window_report_large_groups", "running_sum_exact",
    "group_sums_exact", "correlations_many_columns", "top_words", "table_differences", "profile_files",
]
RUNS, HEADLINE_RUNS = 3, 5


def run(query, spark: SparkSession, folder: str) -> float:
    """Seconds until every row of the result has been made."""
    start = time.perf_counter()
    result: DataFrame = query(spark, folder)
    result.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("proseledger-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in NAMES:
        query = QUERIES[name].run
        run(query, spark, folder)
        runs = HEADLINE_RUNS if name == HEADLINE else RUNS
        times[name] = round(statistics.median(run(query, spark, folder) for _ in range(runs)), 4)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": HEADLINE,
                "value": times[HEADLINE],
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
                "cpus": cpus,
                "total": round(sum(times.values()), 4),
            }
        )
    )


if __name__ == "__main__":
    main()
