"""CSV job time versus input size: the ticket CSV converted from sf0.1, then the same files copied 4 times.

Own measurement for the README (not part of the bench). usage: python scripts/csv_scaling.py
"""

import glob
import os
import shutil
import sys
import time
sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
from pyspark.sql import functions as F
from metrolens.session import build_session, scratch_path
from metrolens.plans import jobs, synthetic as syn
from metrolens.sources import schemas
spark = build_session("local[8]", shuffle_partitions=8)
sf = "/root/testdata/sf0.1"
t_path, s_path = scratch_path(spark, "p-tickets"), scratch_path(spark, "p-segs")
raw = syn.tickets_from_lineitem(spark, sf).select(*[F.col(d).alias(s) for s, d in schemas.TICKET_RENAMES.items()])
raw.repartition(8).write.option("header", True).csv(t_path)
syn.segments_from_supplier(spark, sf).coalesce(1).write.option("header", True).csv(s_path)
local = t_path.replace("file:", "")
for k in (1, 4):
    if k == 4:
        for f in glob.glob(local + "/part-*.csv"):
            for c in range(1, 4):
                shutil.copy(f, f.replace("part-", f"copy{c}-part-"))
    mb = sum(os.path.getsize(f) for f in glob.glob(local + "/*.csv")) / 1e6
    for name, fn in [("segment", lambda o: jobs.tickets_per_segment_job(spark, t_path, s_path, o)),
                     ("hour", lambda o: jobs.tickets_by_hour_job(spark, t_path, o))]:
        best = 1e9
        for _ in range(3):
            o = scratch_path(spark, "p-out"); t0 = time.perf_counter(); fn(o); best = min(best, time.perf_counter() - t0)
        print(f"x{k} {mb:7.1f} MB {name:8s} {best:5.2f}s {mb/best:6.1f} MB/s")
