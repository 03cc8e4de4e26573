"""Write PLANS.md: the physical plan of every batch job.

    python tools/plans.py [sf_dir]

Plans are taken with ``spark.sql.autoBroadcastJoinThreshold=-1``: tables that
grow with the data are then planned as they would be at cluster scale, and
only the size-checked district/area tables broadcast. These are AQE's initial
plans; at runtime AQE may still coalesce partitions or switch a join to
broadcast from measured sizes.
"""

from __future__ import annotations

import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

COUNTED = ["Exchange hashpartitioning", "BroadcastExchange", "SortMergeJoin", "BroadcastHashJoin",
           "Sort [", "Window [", "WindowGroupLimit", "Expand", "HashAggregate", "SortAggregate"]


def main() -> None:
    from carebook.registry import JOBS
    from carebook.session import build_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = build_session(shuffle_partitions=8, app_name="carebook-plans")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    out = ["# PLANS", "",
           "Physical plans of the batch jobs (generated by `tools/plans.py`; auto-broadcast off,",
           "so only the size-checked district/area tables broadcast). Counts are operator",
           "occurrences in the plan text.", "",
           "| Job | shuffles | broadcasts | SMJ | BHJ | sorts | windows | group limits | expands |",
           "| --- | --- | --- | --- | --- | --- | --- | --- | --- |"]
    bodies = []
    for name, job in JOBS.items():
        if name.endswith("_stream") or name == "diary_day_export":
            continue
        plan = job(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        c = {k: plan.count(k) for k in COUNTED}
        out.append(f"| `{name}` | {c['Exchange hashpartitioning']} | {c['BroadcastExchange']} | "
                   f"{c['SortMergeJoin']} | {c['BroadcastHashJoin']} | {c['Sort [']} | {c['Window [']} | "
                   f"{c['WindowGroupLimit']} | {c['Expand']} |")
        text = re.sub(r"#\d+L?", "", plan)
        text = "\n".join(line if len(line) <= 220 else line[:217] + "..." for line in text.splitlines())
        bodies += ["", f"## {name}", "", "```", text, "```"]
    with open(os.path.join(ROOT, "PLANS.md"), "w") as f:
        f.write("\n".join(out + bodies) + "\n")
    spark.stop()


if __name__ == "__main__":
    main()
