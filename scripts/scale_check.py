"""Throughput of the ticket operators as the input grows (own measurement, not a registered query).

The sf0.1 ticket proxy is replicated k times in memory (street labels
rotated per copy) and cached, so the timings cover the operators, not the
input parsing. usage: python scripts/scale_check.py
"""

import sys, time
sys.path.insert(0, __import__("os").path.dirname(__import__("os").path.dirname(__import__("os").path.abspath(__file__))))
from pyspark.sql import functions as F
from metrolens.session import build_session
from metrolens.plans import synthetic as syn
from metrolens.operators import interval_join as ij, temporal
spark = build_session("local[8]", shuffle_partitions=8, driver_memory="8g")
sf = "/root/testdata/sf0.1"
base = syn.tickets_from_lineitem(spark, sf)
for k in (1, 4, 16):
    t = base.crossJoin(spark.range(k).withColumnRenamed("id", "_copy")).repartition(8 * k if k > 1 else 8) \
            .withColumn("StreetName", ((F.col("StreetName").cast("int") + F.col("_copy") * 25) % 25).cast("string"))
    t = t.cache(); n = t.count()
    segs = syn.segments_from_supplier(spark, sf)
    for label, mk in [("segment", lambda: ij.tickets_per_segment(t, segs)),
                      ("segment_day", lambda: ij.tickets_per_segment(temporal.with_ticket_weekday(t, drop_invalid=False), segs, by=["day_of_week"])),
                      ("by_hour", lambda: temporal.tickets_by_hour(t))]:
        best = 1e9
        for _ in range(2):
            t0 = time.perf_counter(); mk().write.format("noop").mode("overwrite").save(); best = min(best, time.perf_counter() - t0)
        print(f"copies={k:2d} rows={n:>9,d} {label:12s} {best:6.2f}s  {n / best / 1e6:6.2f} M rows/s")
    t.unpersist()
