"""Run jobs in a fresh Spark process with an event log; print, for every
stage that read shuffle data, its job, records read and the largest share of
them read by one task.

    python -m tests.skew_probe FIXTURE_DIR LOG_DIR JOB [JOB ...] [--conf KEY=VALUE ...]

``plain_person_window`` is a control: a running sum over
``Window.partitionBy(person)``, which sends each person's rows to one task.
"""

from __future__ import annotations

import json
import os
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def main(argv: list[str]) -> None:
    from pyspark.sql import Window
    from pyspark.sql import functions as F

    from carebook.registry import JOBS
    from carebook.session import build_session
    from carebook.sources.tables import Tables
    from tools.stages import read_events, stage_summary

    more = argv.index("--conf") if "--conf" in argv else len(argv)
    fixture, log_dir, jobs = argv[0], argv[1], argv[2:more]
    conf = dict(pair.split("=", 1) for pair in argv[more + 1:])
    spark = build_session(master="local[4]", shuffle_partitions=8, app_name="carebook-skew-probe", extra_conf={
        "spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir,
        "spark.eventLog.compress": "false", "spark.eventLog.rolling.enabled": "false",
        # keep the 8 shuffle partitions visible: no coalescing, no runtime broadcast
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        # persons with more than 1,000 visits go through day buckets
        "spark.carebook.plainWindowMaxRows": "1000",
        **conf,
    })
    for job in jobs:
        spark.sparkContext.setJobDescription(job)
        if job == "plain_person_window":
            e = Tables(spark, fixture).events
            w = Window.partitionBy("user_id").orderBy("ts", "event_id").rowsBetween(Window.unboundedPreceding, 0)
            df = e.select("event_id", F.sum("value").over(w).alias("running"))
        else:
            df = JOBS[job](spark, fixture)
        df.write.format("noop").mode("overwrite").save()
    spark.stop()
    print(json.dumps([[s["job"], s["shuffle_records"], s["max_shuffle_share"]]
                      for s in stage_summary(read_events(log_dir)) if s["shuffle_records"]]))


if __name__ == "__main__":
    main(sys.argv[1:])
