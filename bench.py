"""Run the headline queries and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose data and cores. Every
query is run to completion into a sink that discards its rows; the first round warms the JVM up and
the best of two further rounds counts.
"""

from __future__ import annotations

import json
import os
import time

from wayfare.plans.catalog import QUERIES
from wayfare.session import build_session

HEADLINE = (
    "stations", "station_districts", "hot_cells", "hot_cell_orders", "cell_representative",
    "order_counts", "passenger_counts", "order_overview", "order_detail", "cdc_latest", "bucket_histogram",
    "gps_points", "order_span", "order_lifecycle", "track_list", "track_replay", "order_history",
    "hourly_series", "failed_tasks", "gauge_extract", "member_rank", "top_members", "set_intersect",
    "time_formats", "html_filter", "word_count",
)
ROUNDS = 2


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "12g"})
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    timings = {}
    for name in HEADLINE:
        run(name)
        timings[name] = round(min(run(name) for _ in range(ROUNDS)), 3)
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(timings.values()), 3),
                      "unit": "sec", "queries": timings,
                      "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()
