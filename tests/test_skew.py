"""A person holding a third of all entries."""

from __future__ import annotations

import datetime as dt
import tempfile

from carebook.plans import register as reg_jobs
from carebook.plans import tallies
from tests.conftest import write_customers, write_events

N = 6000


def _hot_diary():
    d = tempfile.mkdtemp(prefix="carebook-hot-")
    base = dt.datetime(2024, 1, 1)
    rows = [(i, base + dt.timedelta(minutes=7 * i), 0 if i % 3 == 0 else 1 + i % 400, "signup" if i % 5 == 0 else "view",
             float(i % 50) + 0.25, '{"k": %d}' % (i % 7)) for i in range(N)]
    # Several files, so there are several map tasks: AQE splits a skewed
    # partition by ranges of map outputs.
    for part in range(8):
        write_events(f"{d}/events.parquet", rows[part::8], name=f"part-{part}.parquet")
    write_customers(d, list(range(0, 401)))
    _write_hot_orders(d)
    for t in ("nation", "region"):
        import shutil
        shutil.copy(f"/root/testdata/sf0.001/{t}.parquet", f"{d}/{t}.parquet")
    return d


def _write_hot_orders(d: str) -> None:
    """Visits over 300 days; person 0 has a third of them."""
    import pyarrow as pa
    import pyarrow.parquet as pq
    import os
    base = dt.datetime(2023, 1, 1)
    schema = pa.schema([("o_orderkey", pa.int64()), ("o_custkey", pa.int64()), ("o_orderstatus", pa.string()),
                        ("o_totalprice", pa.float64()), ("o_orderdate", pa.timestamp("us")),
                        ("o_orderpriority", pa.string())])
    rows = [{"o_orderkey": i, "o_custkey": 0 if i % 3 == 0 else 1 + i % 400, "o_orderstatus": "O",
             "o_totalprice": 1.0, "o_orderdate": base + dt.timedelta(days=(i * 7) % 300),
             "o_orderpriority": "1"} for i in range(N)]
    os.makedirs(f"{d}/orders.parquet", exist_ok=True)
    for part in range(8):
        pq.write_table(pa.Table.from_pylist(rows[part::8], schema=schema), f"{d}/orders.parquet/part-{part}.parquet")


AQE_SMALL = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1KB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2KB",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


def _with_conf(spark, conf, fn):
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        return fn()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_hot_person_join_is_split_and_complete(spark):
    d = _hot_diary()

    def run():
        df = reg_jobs.diary_enriched(spark, d)
        rows = df.collect()
        return rows, df._jdf.queryExecution().executedPlan().toString()

    rows, plan = _with_conf(spark, AQE_SMALL, run)
    assert len(rows) == N
    assert sum(1 for r in rows if r.user_id == 0) == N // 3
    assert "isFinalPlan=true" in plan and "skew=true" in plan


def test_hot_person_counts_are_exact(spark):
    d = _hot_diary()
    got = {r.n_nationkey: r.view for r in tallies.district_by_kind(spark, d).collect()}
    assert got[0] == N - N // 5 and all(v == 0 for k, v in got.items() if k != 0)


def test_hot_visit_in_worker_load_is_split_and_exact(spark, tmp_path):
    import shutil

    from pyspark.sql import functions as F

    src = "/root/testdata/sf0.001"
    d = str(tmp_path)
    li = spark.read.parquet(f"{src}/lineitem.parquet")
    # a third of all service lines moved onto one visit, by a worker each, so that
    # summing lines per (visit, worker) before the join does not shrink it
    li = li.withColumn("l_suppkey", F.monotonically_increasing_id())
    li = li.withColumn("l_orderkey", F.when(F.col("l_linenumber") % 3 == 0, F.lit(1).cast("long")).otherwise(F.col("l_orderkey")))
    li.repartition(8).write.parquet(f"{d}/lineitem.parquet")
    shutil.copy(f"{src}/orders.parquet", f"{d}/orders.parquet")

    def run():
        df = tallies.worker_month_load(spark, d)
        rows = sorted(tuple(r) for r in df.collect())
        return rows, df._jdf.queryExecution().executedPlan().toString()

    split, plan = _with_conf(spark, dict(AQE_SMALL, **{"spark.sql.adaptive.forceOptimizeSkewedJoin": "false"}), run)
    whole, _ = _with_conf(spark, {"spark.sql.adaptive.skewJoin.enabled": "false"}, run)
    assert "skew=true" in plan
    assert split == whole and len(split) > 0


def test_no_task_receives_the_hot_persons_history(tmp_path):
    """Task-level evidence from Spark's event log. One person holds a third of
    all entries, one customer a third of all visits, and one district has all of
    them. A plain per-person window makes one task read at least a third of the
    rows. In the jobs no task reads 0.3 of a shuffle's rows, nor, in a shuffle smaller
    than the diary (such as a hot person's own branch), 0.3 as many as the diary has.
    (Two of eight blocks may hash to one of the eight partitions: 0.25.) Joins are
    split by AQE, whose sizes are set for this small table."""
    import json
    import os
    import subprocess
    import sys

    d = _hot_diary()
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    jobs = ["running_and_trailing_load", "care_episodes", "latest_entry", "days_without_entry",
            "visit_gaps", "entries_with_last_signup", "concurrent_care", "neighbour_visits", "plain_person_window"]
    conf = [f"{k}={v}" for k, v in AQE_SMALL.items()]
    out = subprocess.run([sys.executable, "-m", "tests.skew_probe", d, str(tmp_path), *jobs, "--conf", *conf],
                         cwd=root, capture_output=True, text=True, timeout=600)
    assert out.returncode == 0, out.stderr[-2000:]
    most = dict.fromkeys(jobs, 0.0)
    for job, records, top in json.loads(out.stdout.strip().splitlines()[-1]):
        if job in most:
            most[job] = max(most[job], top * min(1.0, records / N))
    print(most)
    assert most["plain_person_window"] >= 1 / 3, most
    for job in jobs[:-1]:
        assert 0 < most[job] < 0.3, (job, most)
