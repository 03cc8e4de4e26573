"""Per-person history: latest entry, gaps, running load, episodes, missing days, top workers."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carebook.functions.columns import day_of
from carebook.operators.calendar import missing_days
from carebook.operators.ordered import episodes, previous_in_order, running_total_and_trailing_count
from carebook.operators.ranking import latest_per_key, top_k_per_group
from carebook.sources.tables import Tables

EPISODE_GAP_SECONDS = 2 * 3600
TRAILING_DAYS = 7
TOP_WORKERS = 3
CALENDAR_START = dt.date(2024, 1, 1)
CALENDAR_END = dt.date(2024, 1, 30)
# Keys with at most this many rows are one window in visit_gaps, care_episodes and
# running_and_trailing_load; only keys above it go through day buckets.
PLAIN_WINDOW_MAX_ROWS = 1_000_000
PLAIN_WINDOW_CONF = "spark.carebook.plainWindowMaxRows"


def latest_entry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each person's last entry by ``ts``; a tie goes to the highest ``event_id``."""
    e = Tables(spark, sf_dir).events
    return latest_per_key(e, ["user_id"], ["ts", "event_id"], ["event_type", "value", "props"])


def visit_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each visit with the person's previous visit, in (date, visit key) order,
    and the days between them (null for a person's first visit).

    Persons with more than ``spark.carebook.plainWindowMaxRows`` visits
    (default 1,000,000) are cut into ranges of (date, visit key); the rest take a plain window.
    """
    o = Tables(spark, sf_dir).orders.select("o_orderkey", "o_custkey", "o_orderdate")
    plain_below = int(spark.conf.get(PLAIN_WINDOW_CONF, str(PLAIN_WINDOW_MAX_ROWS)))
    with_prev = previous_in_order(o, ["o_custkey"], ["o_orderdate", "o_orderkey"],
                                  ["o_orderdate", "o_orderkey"], plain_below=plain_below)
    return with_prev.select(
        "o_custkey", "o_orderkey", "o_orderdate",
        F.col("prev.o_orderkey").alias("prev_orderkey"),
        F.col("prev.o_orderdate").alias("prev_orderdate"),
        F.datediff(F.col("o_orderdate"), F.col("prev.o_orderdate")).cast("long").alias("days_since_prev"),
    )


def running_and_trailing_load(spark: SparkSession, sf_dir: str, days: int = TRAILING_DAYS) -> DataFrame:
    """Per entry: the person's running exact sum of ``value`` in (ts, event_id)
    order, and the person's entries in the trailing ``days`` days (inclusive); entries
    without a time come first and count each other."""
    e = Tables(spark, sf_dir).events.select("event_id", "ts", "user_id", "value")
    plain_below = int(spark.conf.get(PLAIN_WINDOW_CONF, str(PLAIN_WINDOW_MAX_ROWS)))
    out = running_total_and_trailing_count(e, ["user_id"], "ts", "event_id", "value", days,
                                           plain_below=plain_below)
    return out.select("event_id", "user_id", "ts", F.col("running_value").cast("double"), "trailing_entries")


def top_workers_by_district(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Top 3 workers of each district by distinct visits (ties: lower worker key)."""
    t = Tables(spark, sf_dir)
    visits = t.lineitem.groupBy("l_suppkey").agg(F.count_distinct("l_orderkey").alias("visits"))
    workers = t.supplier.select("s_suppkey", "s_nationkey")
    ranked = visits.join(workers, F.col("l_suppkey") == F.col("s_suppkey"), "inner")
    top = top_k_per_group(ranked, ["s_nationkey"], TOP_WORKERS,
                          [F.col("visits").desc(), F.col("s_suppkey").asc()], "rank_in_district")
    return top.select("s_nationkey", "s_suppkey", "visits", F.col("rank_in_district").cast("long"))


def care_episodes(spark: SparkSession, sf_dir: str, gap_seconds: int = EPISODE_GAP_SECONDS) -> DataFrame:
    """Episodes of care: runs of a person's entries with no gap over 2 hours (``gap_seconds``).

    ``episode_end`` is the last entry + that gap, as ``session_window`` reports;
    entries without a time are in no episode.
    Persons with more than ``spark.carebook.plainWindowMaxRows`` entries go
    through day buckets; the rest take a plain window.
    """
    e = Tables(spark, sf_dir).events.select("user_id", "ts")
    plain_below = int(spark.conf.get(PLAIN_WINDOW_CONF, str(PLAIN_WINDOW_MAX_ROWS)))
    return episodes(e, ["user_id"], "ts", gap_seconds, plain_below=plain_below)


def days_without_entry(spark: SparkSession, sf_dir: str, start: dt.date = CALENDAR_START,
                       end: dt.date = CALENDAR_END) -> DataFrame:
    """For each person with entries, each day in [start, end] with none."""
    e = Tables(spark, sf_dir).events.where(F.col("user_id").isNotNull())
    return missing_days(e.select("user_id", day_of("ts").alias("day")), ["user_id"], "day", start, end)
