"""Write the executed (AQE final) physical plans of the headline queries to PLANS.md.

usage: python scripts/dump_plans.py [sf_dir]
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from metrolens.plans import registry  # noqa: E402
from metrolens.session import build_session  # noqa: E402

NAMES = ["tickets_per_segment", "tickets_per_segment_day", "tickets_by_hour", "tickets_by_weekday",
         "meters_near_point", "monthly_trips", "geocode_join", "histogram_2d", "tile_pixels", "density_smooth",
         "line_overlay", "cluster_hulls"]


def shorten(plan: str, width: int = 220) -> str:
    out = []
    for line in plan.splitlines():
        line = re.sub(r"#\d+L?", "", line)
        out.append(line if len(line) <= width else line[:width] + " ...")
    return "\n".join(out)


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = build_session("local[8]", shuffle_partitions=8)
    parts = ["# Physical plans of the headline queries",
             "",
             f"Final adaptive plans after one run on `{sf_dir}` (local[8]); expression ids removed, long lines cut.",
             "Generated by `scripts/dump_plans.py`.", ""]
    for name in NAMES:
        df = registry.all_queries()[name](spark, sf_dir)
        df.collect()  # results are small; this runs the plan so AQE's final plan is shown
        plan = df._jdf.queryExecution().executedPlan().toString()
        parts += [f"## {name}", "", "```", shorten(plan), "```", ""]
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w") as f:
        f.write("\n".join(parts))
    spark.stop()


if __name__ == "__main__":
    main()
