"""Physical-plan properties the jobs are designed for.

Plans are taken with auto-broadcast off, as tables that grow with the data
would be on a cluster; only size-checked district/area tables may broadcast.
"""

from __future__ import annotations

import re

import pytest

import __spark_entry__ as se
from carebook.registry import JOBS
from tests.conftest import SMOKE_DIR

BATCH = [n for n in JOBS if not n.endswith("_stream") and n != "diary_day_export"]


@pytest.fixture(scope="module")
def plans(spark):
    from carebook.plans.history import PLAIN_WINDOW_CONF
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    # every person counts as hot, so visit_gaps shows its bucketed route
    spark.conf.set(PLAIN_WINDOW_CONF, "0")
    try:
        yield {n: se.queries()[n](spark, SMOKE_DIR)._jdf.queryExecution().executedPlan().toString()
               for n in BATCH}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        spark.conf.unset(PLAIN_WINDOW_CONF)


def _indent(line: str) -> int:
    return len(line) - len(line.lstrip(" :|+-"))


def _exchange_children(plan: str, key: str, facts=("events.parquet", "orders.parquet")):
    """The operator directly below each shuffle partitioned by ``key`` alone
    whose input reads a diary fact table (entries or visits)."""
    lines = plan.splitlines()
    pat = re.compile(rf"Exchange hashpartitioning\({key}#\d+L?, \d+\)")
    out = []
    for i, line in enumerate(lines):
        if not pat.search(line):
            continue
        depth, j, subtree = _indent(line), i + 1, []
        while j < len(lines) and _indent(lines[j]) > depth:
            subtree.append(lines[j])
            j += 1
        if any(f in x for x in subtree for f in facts):
            out.append(lines[i + 1])
    return out


@pytest.mark.parametrize("name", BATCH)
def test_no_pairs_no_python(plans, name):
    plan = plans[name]
    for op in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
               "FlatMapGroupsInPandas", "MapInPandas"):
        assert op not in plan, (name, op)


@pytest.mark.parametrize("name", BATCH)
def test_scans_read_only_needed_columns(plans, name):
    for schema in re.findall(r"ReadSchema: struct<([^>]*)>", plans[name]):
        assert "props" not in schema or name in (
            "diary_quality_report", "diary_entries_between", "attribute_counts", "attribute_profile", "latest_entry"), (name, schema)


@pytest.mark.parametrize("name,key", [
    ("running_and_trailing_load", "user_id"),
    ("latest_entry", "user_id"), ("days_without_entry", "user_id"),
    ("persons_with_entries", "c_custkey"), ("lapsed_persons", "user_id"),
])
def test_person_keyed_shuffles_carry_reduced_rows(plans, name, key):
    """No raw entry is shuffled by the person key alone (a hot person would
    land in one task); such shuffles carry aggregates or day summaries.
    (visit_gaps and care_episodes are different by design: persons under
    their row threshold take a plain per-person window, each bounded by the
    threshold; see test_routed_jobs_send_only_hot_persons_through_buckets.)"""
    children = _exchange_children(plans[name], key)
    assert children, name
    for child in children:
        assert re.search(r"(Hash|Sort)Aggregate|Union|Window|WindowGroupLimit", child), (name, child)


@pytest.mark.parametrize("name,key", [
    ("running_and_trailing_load", "user_id"), ("care_episodes", "user_id"), ("visit_gaps", "o_custkey"),
])
def test_ordered_scans_shuffle_rows_by_person_day(plans, name, key):
    assert re.search(rf"Exchange hashpartitioning\({key}#\d+L?, _bucket#\d+L?, \d+\)", plans[name]), name


def test_top_k_limits_before_the_shuffle(plans):
    assert "row_number(), 3, Partial" in plans["top_workers_by_district"]


def test_worker_load_has_one_distinct_aggregate_without_expand(plans):
    plan = plans["worker_month_load"]
    assert "Expand" not in plan
    assert plan.count("count(distinct") >= 1 and "SortMergeJoin" in plan


def test_cohorts_join_on_plain_keys(plans):
    for name in ("lapsed_persons", "retained_persons"):
        assert "coalesce(user_id" not in plans[name]


def test_only_bounded_dimensions_broadcast(plans):
    """Broadcasts are the size-checked district table, or the routed jobs'
    list of hot persons (counted before the hint, at most ``max_hot_keys``) and
    what the relations carry (counted too)."""
    for name, plan in plans.items():
        for m in re.finditer(r"BroadcastExchange[^\n]*\n([^\n]*\n){0,6}", plan):
            block = m.group(0)
            if name in ("visit_gaps", "care_episodes", "running_and_trailing_load", "entries_with_last_signup", "concurrent_care") and "_hot_key" in block:
                continue
            # carried totals (one row per block edge), counts per (district, date) and estimates per kind: counted before the hint
            if name in ("concurrent_care", "neighbour_visits", "amount_quantiles_sketch") and re.search("_carried|_group_0|within|_kind", plan):
                continue
            assert re.search(r"nation|region", block) and not re.search(
                r"customer|orders|lineitem|supplier|events", block), (name, block)


def test_sliding_tally_expands_daily_counts_not_entries(plans):
    plan = plans["weekly_sliding_tally"].splitlines()
    i = next(i for i, line in enumerate(plan) if "Expand" in line)
    assert "HashAggregate" in plan[i + 1] and "count(1)" in plan[i + 1]


def test_running_and_trailing_sorts_the_row_union_once(plans):
    sorts = [line for line in plans["running_and_trailing_load"].splitlines()
             if "Sort [" in line and "_bucket#" in line and "_tm#" in line]
    assert len(sorts) == 1, sorts


def test_visit_gaps_without_hot_persons_is_a_plain_window(spark):
    from carebook.plans.history import PLAIN_WINDOW_CONF, PLAIN_WINDOW_MAX_ROWS
    old = spark.conf.get(PLAIN_WINDOW_CONF, None)
    spark.conf.set(PLAIN_WINDOW_CONF, str(PLAIN_WINDOW_MAX_ROWS))
    try:
        plan = se.queries()["visit_gaps"](spark, SMOKE_DIR)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset(PLAIN_WINDOW_CONF) if old is None else spark.conf.set(PLAIN_WINDOW_CONF, old)
    assert "_bucket" not in plan and "Union" not in plan
    assert len(re.findall(r"Exchange hashpartitioning\(o_custkey#\d+L?, \d+\)", plan)) == 1


@pytest.mark.parametrize("name,key", [("visit_gaps", "o_custkey"), ("care_episodes", "user_id")])
def test_routed_jobs_send_only_hot_persons_through_buckets(plans, name, key):
    """With every person hot, the plan has both routes: the bucketed one
    (shuffled by person and day) and the plain one for persons under the
    threshold, split by a broadcast join with the size-checked hot list."""
    plan = plans[name]
    assert re.search(rf"Exchange hashpartitioning\({key}#\d+L?, _bucket#\d+L?, \d+\)", plan)
    assert "BroadcastHashJoin" in plan and "Union" in plan
