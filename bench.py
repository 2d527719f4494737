"""Time the headline queries; prints one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import time

from backlog.plans.queries import all_queries
from backlog.session import local_session

RUNS = 3
HEADLINE = (
    "capacity_by_fuel", "status_counts", "top_zones", "cancellation_rate", "lead_time",
    "top_projects", "delay_detail", "delay_summary", "delay_by_fuel", "dash_capacity_by_fuel",
    "dash_status_counts", "dash_top_projects", "dash_delay_by_fuel", "overview", "study_summary",
    "study_processes", "all_projects", "browse_projects", "browse_metrics", "project_locations",
    "location_rollup", "county_centroid", "geo_enrich", "snapshot_scan", "cluster_union",
    "snapshot_upsert", "snapshot_upsert_batch", "duplicate_keys", "weekly_growth", "data_quality",
)


def main() -> None:
    path = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, partitions=int(cpus) if cpus.isdigit() else 8, app="bench")
    spark.sparkContext.setLogLevel("ERROR")
    queries = all_queries()

    def run(name: str) -> float:
        start = time.perf_counter()
        # Every row of the result is worked out, none is brought to the driver.
        queries[name](spark, path).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    seconds = {}
    for name in HEADLINE:
        run(name)
        seconds[name] = round(statistics.median(run(name) for _ in range(RUNS)), 4)
    print(json.dumps({
        "metric": "headline queries, sum of median warm seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(path.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
