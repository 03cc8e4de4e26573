"""Quality rules, export, broadcast bound and time conversion on made-up inputs."""

from __future__ import annotations

import datetime as dt
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from carebook.functions.columns import instant_day, instant_to_ntz, ntz_to_instant
from carebook.operators.broadcast import bounded_broadcast
from carebook.plans import entries, export
from carebook.sources.tables import Tables
from tests.conftest import SMOKE_DIR, T, write_customers, write_events


NO_FAULTS = {rule: 0 for rule in ("null_time", "null_id", "not_finite_amount", "out_of_range_amount", "sub_cent_amount", "unlisted_kind")}


def test_quality_rules_each_catch_their_row(spark):
    d = tempfile.mkdtemp(prefix="carebook-quality-")
    write_events(d, [
        (1, T("2024-01-01 10:00:00"), 1, "view", 5.0, '{"k": 1}'),     # clean
        (2, T("2024-01-01 11:00:00"), None, "view", 5.0, '{"k": 2}'),  # no person
        (3, T("2024-01-01 12:00:00"), 1, "view", 0.0, '{"k": 3}'),     # value <= 0
        (4, T("2024-01-01 13:00:00"), 1, "view", -2.5, '{"k": 4}'),    # value <= 0
        (5, T("2024-01-01 14:00:00"), 77, "view", 5.0, '{"k": 5}'),    # unknown person
        (6, T("2024-01-01 15:00:00"), 1, "view", 5.0, '{"j": 6}'),     # no $.k
        (7, T("2024-01-01 16:00:00"), 1, "view", 5.0, 'not json'),     # no $.k (malformed)
        (8, T("2024-01-01 17:00:00"), 77, "view", 5.0, '{"k": 8}'),    # unknown person
    ])
    write_customers(d, [1, 2, 3])
    got = {r.rule: r.violations for r in entries.diary_quality_report(spark, d).collect()}
    assert got == {"null_person": 1, "non_positive_value": 2, "unknown_person": 2, "missing_attribute_k": 2, **NO_FAULTS}


def test_quality_report_clean_data_has_zero_counts(spark):
    got = {r.rule: r.violations for r in entries.diary_quality_report(spark, SMOKE_DIR).collect()}
    assert got == {"null_person": 0, "non_positive_value": 0, "unknown_person": 0, "missing_attribute_k": 0, **NO_FAULTS}


def test_entries_between_is_half_open_and_pushed_down(spark):
    d = tempfile.mkdtemp(prefix="carebook-range-")
    write_events(d, [(1, T("2024-01-10 00:00:00"), 1, "view", 1.0, "{}"),
                     (2, T("2024-01-19 23:59:59.999999"), 1, "view", 1.0, "{}"),
                     (3, T("2024-01-20 00:00:00"), 1, "view", 1.0, "{}"),
                     (4, T("2024-01-09 23:59:59"), 1, "view", 1.0, "{}")])
    df = entries.diary_entries_between(spark, d)
    assert sorted(r.event_id for r in df.collect()) == [1, 2]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts,2024-01-10T00:00), LessThan(ts,2024-01-20T00:00)]" in plan


def test_day_export_partitions_and_prunes(spark):
    out = os.path.join(tempfile.mkdtemp(prefix="carebook-export-"), "by-day")
    back = export.diary_day_export(spark, SMOKE_DIR, out)
    days = sorted(p for p in os.listdir(out) if p.startswith("day="))
    assert len(days) == 30 and days[0] == "day=2024-01-01"
    src = Tables(spark, SMOKE_DIR).events
    assert back.count() == src.count()
    assert back.drop("day").exceptAll(src).count() == 0
    one = back.where(F.col("day") == dt.date(2024, 1, 5))
    assert "PartitionFilters: [isnotnull(day" in one._jdf.queryExecution().executedPlan().toString()
    assert one.count() == src.where(F.to_date("ts") == dt.date(2024, 1, 5)).count()
    with pytest.raises(Exception):
        export.diary_day_export(spark, SMOKE_DIR, out)   # never mixes two exports


def test_bounded_broadcast_respects_bound(spark):
    t = Tables(spark, SMOKE_DIR)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        def plan(bound):
            j = t.customer.join(bounded_broadcast(t.nation, bound), F.col("c_nationkey") == F.col("n_nationkey"))
            return j._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan(25)
        assert "BroadcastHashJoin" not in plan(24)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_event_time_conversion_ignores_session_time_zone(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        df = spark.createDataFrame(
            [("2024-03-10 02:30:00.123456",), ("2024-01-30 23:57:12.194062",), ("1969-12-31 23:00:00.5",)],
            "x string").select(F.col("x").cast("timestamp_ntz").alias("ts"))
        out = df.select("ts", instant_to_ntz(ntz_to_instant("ts")).alias("back"),
                        F.unix_micros(ntz_to_instant("ts")).alias("micros"),
                        instant_day(ntz_to_instant("ts")).alias("day")).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    for r in out:
        assert r.back == r.ts
        assert r.day == r.ts.date()
        epoch = dt.datetime(1970, 1, 1)
        assert r.micros == (r.ts - epoch) // dt.timedelta(microseconds=1)


def test_top_workers_break_ties_by_lower_worker_key(spark):
    import pyarrow as pa
    import pyarrow.parquet as pq

    from carebook.plans import history

    d = tempfile.mkdtemp(prefix="carebook-topk-")
    # district 0: workers 5, 3, 4 with 2 visits each and worker 9 with 1 (plus a
    # repeated line on one visit, which must not count twice); district 1: worker 7.
    lines = [(1, 5), (2, 5), (3, 3), (4, 3), (4, 3), (5, 4), (6, 4), (7, 9), (8, 7)]
    li_schema = pa.schema([("l_orderkey", pa.int64()), ("l_partkey", pa.int64()), ("l_suppkey", pa.int64()),
                           ("l_linenumber", pa.int32()), ("l_quantity", pa.float64()),
                           ("l_extendedprice", pa.float64()), ("l_discount", pa.float64()), ("l_tax", pa.float64()),
                           ("l_returnflag", pa.string()), ("l_linestatus", pa.string()),
                           ("l_shipdate", pa.timestamp("us"))])
    pq.write_table(pa.Table.from_pylist([
        {"l_orderkey": o, "l_partkey": 1, "l_suppkey": s, "l_linenumber": 1, "l_quantity": 1.0,
         "l_extendedprice": 1.0, "l_discount": 0.0, "l_tax": 0.0, "l_returnflag": "N", "l_linestatus": "O",
         "l_shipdate": dt.datetime(2024, 1, 1)} for o, s in lines], schema=li_schema), f"{d}/lineitem.parquet")
    su_schema = pa.schema([("s_suppkey", pa.int64()), ("s_name", pa.string()), ("s_nationkey", pa.int32()),
                           ("s_acctbal", pa.float64())])
    pq.write_table(pa.Table.from_pylist([
        {"s_suppkey": s, "s_name": f"w{s}", "s_nationkey": 1 if s == 7 else 0, "s_acctbal": 0.0}
        for s in (3, 4, 5, 7, 9)], schema=su_schema), f"{d}/supplier.parquet")
    got = sorted(tuple(r) for r in history.top_workers_by_district(spark, d).collect())
    assert got == [(0, 3, 2, 1), (0, 4, 2, 2), (0, 5, 2, 3), (1, 7, 1, 1)]


ODD_AMOUNTS = [(1, "2024-01-05 10:00:00", 1, "view", 1e11), (2, "2024-01-05 10:00:00", 1, "view", float("nan")),
               (3, "2024-01-05 10:00:00", 1, "meals", float("inf")), (4, "2024-01-05 10:00:00", 1, None, 1e12),
               (5, None, 1, "view", 0.125), (None, "2024-01-05 11:00:00", 1, "view", 2.5), (None, "2024-01-05 11:00:00", 1, "view", 2.5)]


def _odd_diary():
    import shutil
    import tempfile

    from tests.conftest import T, write_customers, write_events
    d = tempfile.mkdtemp(prefix="carebook-odd-")
    write_events(d, [(i, ts and T(ts), user, kind, value, '{"k": 1}') for i, ts, user, kind, value in ODD_AMOUNTS])
    write_customers(d, [1, 2])
    for t in ("nation", "region"):
        shutil.copy(f"/root/testdata/sf0.001/{t}.parquet", f"{d}/{t}.parquet")
    return d


def test_faulty_entries_are_counted_not_dropped(spark):
    import __spark_entry__ as se
    from tests.oracle_harness import compare, duck
    d = _odd_diary()
    con = duck(d)
    rules = {r.rule: r.violations for r in se.queries()["diary_quality_report"](spark, d).collect()}
    assert {k: v for k, v in rules.items() if v} == {
        "null_time": 1, "null_id": 2, "not_finite_amount": 2, "out_of_range_amount": 1, "sub_cent_amount": 1, "unlisted_kind": 2}
    for name in ("diary_quality_report", "person_day_services", "district_by_kind", "running_and_trailing_load", "weekly_sliding_tally"):
        r = compare(spark, name, d, con)
        assert r["columns_match"] and r["values_match"], r
    kinds = [r.asDict() for r in se.queries()["district_by_kind"](spark, d).collect()]
    total = sum(v for r in kinds for k, v in r.items() if not k.startswith("n_"))
    grand = [r.entries for r in se.queries()["district_rollup"](spark, d).collect() if r.grouping_level == 3]
    assert grand == [total] == [len(ODD_AMOUNTS)]


def test_entries_without_an_id_pass_the_dedup(spark):
    from carebook.streaming import jobs
    d = _odd_diary()
    assert jobs.dedup_entries_stream(spark, d).count() == len(ODD_AMOUNTS)


def test_export_writes_few_files_from_shuffled_input(spark):
    import os
    import tempfile

    from pyspark.sql import functions as F

    from carebook.sources.export import write_by_day
    from carebook.sources.tables import Tables
    path = tempfile.mkdtemp(prefix="carebook-export-") + "/out"
    events = Tables(spark, "/root/testdata/sf0.01").events
    write_by_day(events.repartition(40, F.rand(1)), path)
    days = [x for x in os.listdir(path) if x.startswith("day=")]
    files = sum(f.endswith(".parquet") for x in days for f in os.listdir(f"{path}/{x}"))
    assert len(days) == 30 and files <= 2 * len(days)
    assert spark.read.parquet(path).count() == events.count()
