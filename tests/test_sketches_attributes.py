"""Stored sketches, attribute profiles and the table function against plain versions."""

from __future__ import annotations

import datetime as dt
import json
import random
import shutil

from carebook.operators import daily_state
from carebook.plans import attributes, sketches
from carebook.session import fresh_dir
from tests.conftest import SMOKE_DIR, T, write_customers, write_events


def _diary(tmp_path, persons=3000, entries=9000):
    rnd = random.Random(1)
    base = T("2024-01-10 00:00:00")
    rows = [(i, base + dt.timedelta(minutes=rnd.randrange(10 * 1440)), rnd.randrange(persons), rnd.choice(["view", "click", None]),
             rnd.choice([1.5, 2.5, round(rnd.random() * 100, 2)]), "{}") for i in range(entries)]
    rows += [(90_001, None, 1, "view", 3.0, None), (90_002, base, None, "view", 3.0, None), (90_003, base, 2, "view", float("nan"), None),
             (90_004, base, 2, "view", float("inf"), None), (90_005, base, 2, "view", None, None), (90_006, base, 999_999, "view", 1.0, None)]
    write_events(tmp_path, rows)
    write_customers(tmp_path, list(range(persons)), nation=4)
    for t in ("nation", "region"):
        shutil.copy(f"{SMOKE_DIR}/{t}.parquet", f"{tmp_path}/{t}.parquet")
    return rows


def test_persons_of_any_period_from_stored_days(spark, tmp_path):
    rows = _diary(tmp_path)
    store = fresh_dir(spark, "t-persons")
    for a, z in ((None, dt.date(2024, 1, 13)), (dt.date(2024, 1, 13), dt.date(2024, 1, 16)), (dt.date(2024, 1, 16), None), (dt.date(2024, 1, 12), dt.date(2024, 1, 14))):
        sketches.extend_person_sketches(spark, str(tmp_path), store, a, z)   # the last extends again what is there
    assert spark.read.parquet(store).groupBy("day", "c_nationkey").count().where("count > 1").count() == 0
    for a, z in ((None, None), (dt.date(2024, 1, 11), dt.date(2024, 1, 12)), (dt.date(2024, 1, 12), dt.date(2024, 1, 18))):
        exact = len({u for _, ts, u, _, _, _ in rows if ts and u is not None and u < 3000 and (a is None or ts.date() >= a) and (z is None or ts.date() < z)})
        (got,) = sketches.period_persons(spark, store, a, z).collect()
        assert got.c_nationkey == 4 and abs(got.persons - exact) <= 0.03 * exact
    (row,) = sketches.period_persons_sketch(spark, str(tmp_path)).collect()
    assert row.estimate_is_near and row.n_nationkey == 4


def test_a_day_with_sketches_is_read_alone(spark, tmp_path):
    _diary(tmp_path, 50, 200)
    store = fresh_dir(spark, "t-persons")
    sketches.extend_person_sketches(spark, str(tmp_path), store)
    one = daily_state.read(spark, store, sketches._schema(sketches._PERSON_STATE), dt.date(2024, 1, 11), dt.date(2024, 1, 12))
    assert "PartitionFilters: [isnotnull(day" in one._jdf.queryExecution().executedPlan().toString()


def test_amount_quantiles_have_the_stated_rank(spark, tmp_path):
    rows = _diary(tmp_path)
    got = sketches.amount_quantiles_sketch(spark, str(tmp_path)).collect()
    assert len(got) == 3 * len(sketches.QUANTILES) and all(r.rank_is_near for r in got)
    finite = {}
    for _, ts, _, kind, v, _ in rows:
        if ts and v is not None and abs(v) < float("inf"):
            finite[kind] = finite.get(kind, 0) + 1
    assert {r.event_type: r.amounts for r in got} == finite


def test_sketches_of_nothing(spark, tmp_path):
    write_events(tmp_path, [])
    write_customers(tmp_path, [1])
    shutil.copy(f"{SMOKE_DIR}/nation.parquet", f"{tmp_path}/nation.parquet")
    assert sketches.period_persons_sketch(spark, str(tmp_path)).collect() == []
    assert sketches.amount_quantiles_sketch(spark, str(tmp_path)).collect() == []


TEXTS = [None, "", "{", "[1, 2]", "3", '"x"', "null", "{}", '{"k": 1}', '{"k": 1}', '{"k": 2.5, "n": {"a": [1]}}', '{"k": "1", "n": null}', '{"k": true, "n": [1]}',
         '{"k": 1, "k": 2}', '{"a b.c": "ü"}', '{"n": {"a": [1]}}']


def test_profile_of_any_json(spark):
    df = spark.createDataFrame([(t, 1) for t in TEXTS * 3], "props string, part int")
    got = {(r.part, r.attribute): (r.entries, r.distinct_values, r.types) for r in attributes.profile(df, "props").collect()}
    faults = {"missing": 0, "malformed": 0, "not_object": 0}
    seen: dict[str, list] = {}
    names = {bool: "boolean", int: "number", float: "number", str: "string", dict: "object", list: "array", type(None): "null"}
    for t in TEXTS * 3:
        if t is None:
            faults["missing"] += 1
            continue
        try:
            v = json.loads(t)
        except ValueError:
            v = faults  # not valid
        if v is faults or t == '{"k": 1, "k": 2}':
            faults["malformed"] += 1
        elif not isinstance(v, dict):
            faults["not_object"] += 1
        else:
            for k, x in v.items():
                seen.setdefault(k, []).append(x)
    expected = {("attribute", k): (len(xs), len({json.dumps(x) for x in xs}), ",".join(sorted({names[type(x)] for x in xs}))) for k, xs in seen.items()}
    expected |= {(f, None): (n, 0, "") for f, n in faults.items()}
    assert got == expected


def test_profile_of_nothing(spark):
    got = attributes.profile(spark.createDataFrame([], "props string"), "props").collect()
    assert sorted((r.part, r.entries) for r in got) == [("malformed", 0), ("missing", 0), ("not_object", 0)]


def test_rota_from_sql_and_laterally(spark):
    name = attributes.create_rota(spark, "rota_here")
    days = [r.day for r in spark.sql(f"SELECT * FROM {name}(7, DATE'2024-01-05', DATE'2024-01-09')").collect()]
    assert days == [dt.date(2024, 1, 5), dt.date(2024, 1, 8), dt.date(2024, 1, 9)]
    spark.createDataFrame([(1, dt.date(2024, 1, 1), dt.date(2024, 1, 2)), (2, dt.date(2024, 1, 6), dt.date(2024, 1, 7)), (3, dt.date(2024, 2, 2), dt.date(2024, 2, 1)),
                           (4, None, dt.date(2024, 1, 1)), (None, dt.date(2024, 1, 1), dt.date(2024, 1, 1))], "w long, a date, z date").createOrReplaceTempView("t_spans")
    rows = spark.sql(f"SELECT r.* FROM t_spans, LATERAL {name}(w, a, z) AS r")
    assert sorted(map(tuple, rows.collect())) == [(1, dt.date(2024, 1, 1)), (1, dt.date(2024, 1, 2))]


def test_no_python_and_no_cross_join(spark):
    for job in (sketches.period_persons_sketch, sketches.amount_quantiles_sketch, attributes.attribute_profile, attributes.worker_rota):
        plan = job(spark, SMOKE_DIR)._jdf.queryExecution().executedPlan().toString()
        assert not any(x in plan for x in ("Cartesian", "NestedLoop", "Python", "InPandas", "InArrow")), plan
