"""As-of, interval and band joins against plain versions, with hot keys cut."""

from __future__ import annotations

import datetime as dt
import tempfile
from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from carebook.operators.asof import as_of_join
from carebook.operators.blocks import BLOCK, running_sums, sorted_blocks
from carebook.operators.intervals import band_counts, busiest_times
from carebook.plans import relations
from tests.conftest import T, write_customers, write_events

BASE = dt.datetime(2024, 1, 1)
ROW = st.tuples(st.one_of(st.none(), st.sampled_from([1, 1, 1, 2, 3])), st.one_of(st.none(), st.integers(0, 40)))
LEFT = "k long, ts timestamp_ntz, i long"


def _at(hours):
    return None if hours is None else BASE + dt.timedelta(hours=hours)


def _frame(spark, rows):
    return spark.createDataFrame([(k, _at(h), i) for i, (k, h) in enumerate(rows)], LEFT)


def _as_of(left, right, strict):
    out = []
    for i, (k, h) in enumerate(left):
        before = [(rh, j) for j, (rk, rh) in enumerate(right)
                  if None not in (k, h, rk, rh) and rk == k and (rh < h if strict else rh <= h)]
        out.append((i, max(before)[1] if before else None))
    return sorted(out)


@settings(max_examples=12, deadline=None)
@given(left=st.lists(ROW, max_size=25), right=st.lists(ROW, max_size=25), strict=st.booleans(), below=st.sampled_from([None, 3, 1000]))
def test_as_of_equals_looking_back(spark, left, right, strict, below):
    joined = as_of_join(_frame(spark, left), _frame(spark, right), ["k"], "ts", "i", ["i"], "found", strict=strict,
                        bucket_seconds=7200, plain_below=below)
    assert joined.columns == ["k", "ts", "i", "found"]
    assert sorted((r.i, r.found.i if r.found else None) for r in joined.collect()) == _as_of(left, right, strict)


def test_as_of_cuts_a_hot_key(spark):
    """A key with a third of all rows goes through time buckets, with a match carried over empty ones."""
    left = [(0 if i % 3 == 0 else i, i % 500) for i in range(1500)]
    right = [(0, 1), (0, 1), (0, 300), (7, 2)]
    joined = as_of_join(_frame(spark, left), _frame(spark, right), ["k"], "ts", "i", ["i", "ts"], "found", plain_below=50)
    assert "_bucket" in joined._jdf.queryExecution().analyzed().toString()
    assert sorted((r.i, r.found.i if r.found else None) for r in joined.collect()) == _as_of(left, right, True)


def test_last_signup_of_odd_entries(spark, tmp_path):
    e = [(1, T("2024-01-01 10:00:00"), 1, "signup", 1.0, None), (2, T("2024-01-01 10:00:00"), 1, "signup", 1.0, None),
         (3, T("2024-01-01 10:00:00"), 1, "view", 1.0, None), (4, T("2024-01-01 10:00:01"), 1, "view", 1.0, None),
         (5, T("2024-01-02 10:00:00"), 2, "view", 1.0, None), (6, None, 1, "view", 1.0, None), (7, None, 1, "signup", 1.0, None),
         (8, T("2024-01-03 10:00:00"), None, "view", 1.0, None), (9, T("2024-01-01 10:00:00"), None, "signup", 1.0, None),
         (10, T("2024-01-01 11:00:00"), 1, "signup", 1.0, None)]
    write_events(tmp_path, e)
    got = {r.event_id: r.signup_id for r in relations.entries_with_last_signup(spark, str(tmp_path)).collect()}
    assert got == {1: None, 2: None, 3: None, 4: 2, 5: None, 6: None, 7: None, 8: None, 9: None, 10: 2}


@settings(max_examples=10, deadline=None)
@given(rows=st.lists(st.tuples(st.one_of(st.none(), st.sampled_from([1, 1, 2])), st.integers(0, 30), st.one_of(st.none(), st.integers(-5, 5))), max_size=40),
       parts=st.sampled_from([1, 3, 7]))
def test_running_sums_over_blocks(spark, rows, parts):
    rows = [(g, t, i, v) for i, (g, t, v) in enumerate(rows)]
    df = spark.createDataFrame(rows, "g int, t int, i int, v long")
    got = {r.i: r.s for r in running_sums(df, ["g"], ["t", "i"], {"s": "v"}, parts).collect()}
    assert got == {i: sum(w or 0 for h, u, j, w in rows if h == g and (u, j) <= (t, i)) for g, t, i, _ in rows}


def test_a_hot_group_lies_in_many_blocks(spark):
    df = spark.range(9000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("g"), "id")
    blocks = [r["count"] for r in sorted_blocks(df, ["g"], ["id"], 12).where("g = 0").groupBy(BLOCK).count().collect()]
    assert len(blocks) >= 3 and max(blocks) < 1500


@settings(max_examples=10, deadline=None)
@given(rows=st.lists(st.tuples(st.sampled_from([1, 1, 2]), st.one_of(st.none(), st.integers(0, 20)), st.one_of(st.none(), st.integers(-2, 8))), max_size=30),
       parts=st.sampled_from([1, 5]))
def test_busiest_times_equal_counting(spark, rows, parts):
    made = [(g, _at(a), _at(a + n) if None not in (a, n) else None) for g, a, n in rows]
    got = sorted(map(tuple, busiest_times(spark.createDataFrame(made, "g int, a timestamp_ntz, z timestamp_ntz"), ["g"], "a", "z", parts).collect()))
    expected = []
    for g in (1, 2):
        mine = [(a, z) for h, a, z in made if h == g and None not in (a, z) and a < z]
        open_at = {t: sum(a <= t < z for a, z in mine) for t in sorted({x for both in mine for x in both})}
        if mine:
            peak = max(open_at.values())
            since = min(t for t, n in open_at.items() if n == peak)
            expected.append((g, peak, since, min(t for t, n in open_at.items() if t > since and n < peak)))
    assert got == expected


@settings(max_examples=10, deadline=None)
@given(rows=st.lists(st.tuples(st.one_of(st.none(), st.sampled_from([1, 1, 2])), st.one_of(st.none(), st.integers(0, 60))), max_size=40),
       hours=st.sampled_from([0, 1, 6]), parts=st.sampled_from([1, 5]))
def test_band_counts_equal_pairs(spark, rows, hours, parts):
    df = spark.createDataFrame([(g, _at(h)) for g, h in rows], "g int, ts timestamp_ntz")
    got = sorted(map(tuple, band_counts(df, ["g"], "ts", hours * 3600, "n", parts).collect()), key=str)
    assert got == sorted(((g, _at(h), sum(x == g and y is not None and abs(y - h) <= hours for x, y in rows))
                          for g, h in set(rows) if h is not None), key=str)


def test_neighbour_visits_of_a_hot_district(spark):
    """Most visits lie in one district, many on one day; a visit without a date or a known person."""
    import os

    import pyarrow as pa
    import pyarrow.parquet as pq
    d = tempfile.mkdtemp(prefix="carebook-band-")
    write_customers(d, list(range(20)), nation=3)
    dates = [dt.datetime(1995, 1, 1) + dt.timedelta(days=0 if i % 3 == 0 else i % 90) for i in range(600)] + [None, dt.datetime(1995, 1, 2)]
    people = [i % 20 for i in range(600)] + [1, 99]
    os.makedirs(f"{d}/orders.parquet", exist_ok=True)
    pq.write_table(pa.table({"o_orderkey": list(range(602)), "o_custkey": people, "o_orderstatus": ["O"] * 602, "o_totalprice": [1.0] * 602,
                             "o_orderdate": pa.array(dates, pa.timestamp("us")), "o_orderpriority": ["1"] * 602}), f"{d}/orders.parquet/part-0.parquet")
    got = {r.o_orderkey: r.neighbours for r in relations.neighbour_visits(spark, d).collect()}
    per_day = Counter(x for x in dates[:600])
    assert got.pop(600) is None and 601 not in got
    assert got == {i: sum(per_day[dates[i] + dt.timedelta(days=k)] for k in range(-3, 4)) - 1 for i in range(600)}


def test_plans_make_no_pairs(spark):
    from tests.conftest import SMOKE_DIR
    for job in (relations.entries_with_last_signup, relations.concurrent_care, relations.neighbour_visits):
        plan = job(spark, SMOKE_DIR)._jdf.queryExecution().executedPlan().toString()
        assert not any(x in plan for x in ("Cartesian", "NestedLoop", "Python", "InPandas", "InArrow")), plan
