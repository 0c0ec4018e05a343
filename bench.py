"""Time the headline queries and print one JSON line.

Every query is run once to warm up and then three times; the median counts. Results go to Spark's ``noop`` sink, so that
all rows and columns are computed and nothing is collected.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from filmgrid.registry import all_queries  # noqa: E402
from filmgrid.session import build_session, scratch  # noqa: E402

HEADLINE = [
    "genre_revenue_weekly",
    "genre_popularity_weekly",
    "genre_week_grid",
    "extreme_films",
    "margin_by_director",
    "collection_revenue",
    "domestic_vs_international",
    "actor_avg_revenue",
    "roi_trimmed",
    "roi_histogram",
    "roi_density",
    "budget_revenue_trend",
    "engagement_long",
    "top5_films",
    "competitors_window",
    "people_ids_new",
    "last_month_ids",
    "title_normalised_documents",
    "clean_movies",
    "clean_collections",
    "clean_video_stats",
    "changes_to_columns",
    "weekly_performance",
    "latest_by_key",
    "upsert_orders",
    "update_nonnull_orders",
    "lr_predict",
    "rf_predict",
    "forecast_predict",
    "warehouse_upsert",
    "incremental_upsert",
    "nearest_title_match",
    "weekly_performance_after_updates",
    "planned_features",
]
RUNS = 3


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 8))
    spark = build_session("bench", master=f"local[{cpus}]", cores=cpus)
    spark.sparkContext.setLogLevel("ERROR")
    if not spark.conf.get("spark.checkpoint.dir", None):
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="filmgrid-bench-"))
    queries = all_queries()

    def run(name: str) -> float:
        start = time.perf_counter()
        spark.catalog.clearCache()  # nothing that an earlier run kept
        with scratch(spark):
            queries[name].run(spark, folder).write.format("noop").mode("overwrite").save()
            return time.perf_counter() - start

    seconds = {}
    for name in HEADLINE:
        run(name)
        seconds[name] = round(statistics.median(run(name) for _ in range(RUNS)), 3)
    result = {
        "metric": "sum of the median seconds of the headline queries",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(folder).removeprefix("sf"),
        "cpus": cpus,
    }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
