"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from rinkflow.plans.catalog import QUERIES, landing, standins  # noqa: E402
from rinkflow.session import local_session  # noqa: E402

HEADLINES = [
    "q1_curated_view", "q2_enriched_results", "q3_main_page", "q4_prediction_page",
    "q5_cascading_facets", "j1_join_conditions", "j2_join_weather",
    "j3_join_previous_season_best", "j5_resolve_entities", "w1_pair_index", "w3_tfm_break_reset",
    "w4_first_per_key", "a1_corrected_difference", "a2_avg_by", "a3_summary_stats",
    "a4_quartiles", "a6_box_by_year", "a8_histogram", "a9_linear_trend", "a10_lowess_trend",
    "a10_lowess_trend_continuous", "j5_resolve_crowded",
    "a12_weather_request_plan", "a14_season_best_table", "f9_time_to_seconds",
    "f20_predicted_performance", "s5_explode_results", "s8_write_semicolon_csv",
]


def run(spark, name, folder):
    begun = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - begun, 3)


def main():
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINES
    spark = local_session(cores, shuffle_partitions=8, app_name="bench")
    spark.sparkContext.setLogLevel("ERROR")
    # One untimed pass over a small table starts the JVM, Python workers and code cache.
    run(spark, "a2_avg_by", folder)
    run(spark, "j5_resolve_entities", folder)
    # Documents and the stored view that queries read are written outside the timing.
    landing.landed_races(spark, folder)
    landing.landed_results(spark, folder)
    standins.stored_view(spark, folder)
    times = {name: run(spark, name, folder) for name in names}
    print(
        json.dumps(
            {
                "metric": "headline queries, total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
