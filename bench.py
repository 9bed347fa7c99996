"""Times the headline queries and K-Means fits; prints one JSON line.

BENCH_SF_DIR names the tables, BENCH_CPUS the local cores. Every query runs once to
warm up, then BENCH_RUNS times into a sink that discards its rows; the median counts.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from pyspark.sql import SparkSession

from tripmarts.operators import kmeans
from tripmarts.plans.queries import REGISTRY
from tripmarts.sources import star

QUERIES = [
    "clean_trips",
    "clean_report",
    "order_clean_report",
    "dedup_all",
    "dedup_rare",
    "dedup_key",
    "quality_profile",
    "high_value_flag",
    "zone_enrich",
    "zone_enrich_large",
    "location_stats",
    "clean_location_stats",
    "order_location_stats",
    "hourly_pattern",
    "peak_hour",
    "cluster_metrics",
    "cluster_metrics_from_cells",
    "rank_combined",
    "hotspot_report",
    "nearest_center",
    "silhouette_pinned",
    "kmeans_full",
    "kmeans_validation",
    "stream_cluster_counts",
    "stream_top_locations",
]
# Row counts of the published K-Means timings.
SIZES = [10_000, 50_000, 100_000, 500_000]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        start = time.perf_counter()
        REGISTRY[name](spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    seconds = {}
    for name in QUERIES:
        run(name)
        seconds[name] = round(statistics.median(run(name) for _ in range(runs)), 3)

    rows = star.table(spark, folder, "lineitem").selectExpr("CAST(l_suppkey AS DOUBLE) AS location")
    kmeans.scale_sweep(rows, SIZES[:1], "location")
    for label, collapse in (("rows", False), ("points", True)):
        for row in kmeans.scale_sweep(rows, SIZES, "location", collapse=collapse).collect():
            if row.status == "success":
                seconds[f"kmeans_{label}_{row.n_samples}"] = round(row.time_seconds, 3)

    print(json.dumps({
        "metric": "total time of all queries",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
