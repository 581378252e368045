"""Benchmark the headline queries; prints one JSON line.

env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
     BENCH_RUNS (default 3; the best run per query is reported).
Each query is executed in full with the no-op sink (no collect to the driver).
hour, per weekday) end to end on reference-shaped ticket CSV converted once
from the given tables, and reports input MB/s.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from metrolens.plans import jobs, registry  # noqa: E402
from metrolens.plans import synthetic as syn  # noqa: E402
from metrolens.session import build_session, scratch_path  # noqa: E402
from metrolens.sources import schemas  # noqa: E402

HEADLINE = [
    "tickets_per_segment",        # baseline: 73.3 s on ~3 GB tickets + 50 MB segments
    "tickets_by_hour",            # baseline: 15.3 s on ~3 GB
    "tickets_by_weekday",         # baseline: 13.1 s on ~3 GB
    "meters_near_point",
    "tickets_per_segment_day",
    "tickets_per_segment_hour",
    "monthly_trips",
    "bbox_trips",
    "geocode_join",
    "bike_clean",
    "histogram_2d",
    "tile_pixels",
    "density_smooth",
    "line_overlay",
    "cluster_hulls",
    "fare_distance_fit",
]


def _local_bytes(path: str) -> int:
    root = path.replace("file:", "")
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, fs in os.walk(root) for f in fs if f.endswith(".csv"))


def csv_jobs(spark, sf_dir: str, runs: int, cpus: int) -> dict:
    t_path, s_path = scratch_path(spark, "bench-tickets-csv"), scratch_path(spark, "bench-segments-csv")
    raw = syn.tickets_from_lineitem(spark, sf_dir).select(
        *[F.col(dst).alias(src) for src, dst in schemas.TICKET_RENAMES.items()])
    raw.repartition(cpus).write.option("header", True).csv(t_path)
    syn.segments_from_supplier(spark, sf_dir).coalesce(1).write.option("header", True).csv(s_path)
    mb = _local_bytes(t_path) / 1e6
    runs_by_job = {
        "tickets_per_segment": lambda out: jobs.tickets_per_segment_job(spark, t_path, s_path, out),
        "tickets_by_hour": lambda out: jobs.tickets_by_hour_job(spark, t_path, out),
        "tickets_by_weekday": lambda out: jobs.tickets_by_weekday_job(spark, t_path, out),
    }
    out = {}
    for name, fn in runs_by_job.items():
        best = None
        for _ in range(runs):
            target = scratch_path(spark, f"bench-out-{name}")
            t0 = time.perf_counter()
            fn(target)
            dt = time.perf_counter() - t0
            best = dt if best is None else min(best, dt)
        out[name] = {"sec": round(best, 3), "input_mb": round(mb, 1), "mb_per_sec": round(mb / best, 1)}
    return out


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = build_session(f"local[{cpus}]", app="metrolens-bench", shuffle_partitions=cpus)
    spark.range(1000).selectExpr("sum(id)").collect()  # start the executors once
    qs = registry.all_queries()
    times: dict[str, float] = {}
    for name in HEADLINE:
        best = None
        for _ in range(runs):
            t0 = time.perf_counter()
            qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            dt = time.perf_counter() - t0
            best = dt if best is None else min(best, dt)
        times[name] = round(best, 3)
    csv = csv_jobs(spark, sf_dir, runs, cpus)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "csv_jobs": csv, "sf": sf, "cpus": cpus, "runs": runs, "stat": "min"}))
    spark.stop()


if __name__ == "__main__":
    main()
