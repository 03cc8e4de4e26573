"""Rows related by time: as-of, interval and band joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carebook.operators.asof import as_of_join
from carebook.operators.broadcast import bounded_broadcast
from carebook.operators.intervals import band_counts, busiest_times
from carebook.plans.history import EPISODE_GAP_SECONDS, PLAIN_WINDOW_CONF, PLAIN_WINDOW_MAX_ROWS, care_episodes
from carebook.sources.schemas import MAX_DISTRICTS
from carebook.sources.tables import Tables

SIGNUP = "signup"
BAND_DAYS = 3
MAX_TIMES = 1_000_000


def entries_with_last_signup(spark: SparkSession, sf_dir: str, kind: str = SIGNUP) -> DataFrame:
    """Each entry with its person's latest ``signup`` strictly before it.

    Of signups at one time the one with the highest ``event_id`` counts; null for
    an entry that has none, or has no person or no time. Persons with more than
    ``spark.carebook.plainWindowMaxRows`` rows are cut into time buckets.
    """
    e = Tables(spark, sf_dir).events.select("event_id", "ts", "user_id", "event_type")
    plain_below = int(spark.conf.get(PLAIN_WINDOW_CONF, str(PLAIN_WINDOW_MAX_ROWS)))
    signups = e.where(F.col("event_type") == kind)
    joined = as_of_join(e, signups, ["user_id"], "ts", "event_id", ["event_id", "ts"], "signup", plain_below=plain_below)
    return joined.select("event_id", "ts", "user_id", "event_type", F.col("signup.event_id").alias("signup_id"), F.col("signup.ts").alias("signup_ts"))


def concurrent_care(spark: SparkSession, sf_dir: str, gap_seconds: int = EPISODE_GAP_SECONDS) -> DataFrame:
    """Per district the most care episodes open at once, when first, and until when.

    An episode is open from its start until its end, end exclusive. Districts
    without an episode, and persons who are not in the register, have no row.
    Episodes meet the register by person; the calendar bounds how many one person has.
    """
    t = Tables(spark, sf_dir)
    persons = t.customer.select("c_custkey", "c_nationkey")
    episodes = care_episodes(spark, sf_dir, gap_seconds).join(persons, F.col("user_id") == F.col("c_custkey"))
    peaks = busiest_times(episodes.where(F.col("c_nationkey").isNotNull()), ["c_nationkey"], "episode_start", "episode_end")
    names = bounded_broadcast(t.nation.select("n_nationkey", "n_name"), MAX_DISTRICTS)
    return peaks.join(names, F.col("c_nationkey") == F.col("n_nationkey")).select(
        "n_nationkey", "n_name", F.col("peak").alias("open_episodes"), "peak_start", "peak_end")


def neighbour_visits(spark: SparkSession, sf_dir: str, days: int = BAND_DAYS) -> DataFrame:
    """Per visit, how many other visits its district has within ``days`` days before or after (inclusive).

    Null for a visit without a date; a visit of a person who is not in the register
    has no district and no row. Visits are counted per (district, date), whose
    counts are broadcast up to 1,000,000 of them and joined by a shuffle beyond.
    """
    t = Tables(spark, sf_dir)
    persons = t.customer.where(F.col("c_nationkey").isNotNull()).select("c_custkey", "c_nationkey")
    visits = t.orders.select("o_orderkey", "o_custkey", "o_orderdate").join(persons, F.col("o_custkey") == F.col("c_custkey"))
    # Counted per person and date before the register join, so a busy person's visits of a day are one row of it.
    per_person = t.orders.groupBy("o_custkey", "o_orderdate").agg(F.count(F.lit(1)).alias("_visits"))
    dated = per_person.join(persons, F.col("o_custkey") == F.col("c_custkey"))
    near = band_counts(dated, ["c_nationkey"], "o_orderdate", days * 86_400, "within", weight="_visits")
    near = near.select(F.col("c_nationkey").alias("_district"), F.col("o_orderdate").alias("_date"), "within")
    same = (F.col("c_nationkey") == F.col("_district")) & (F.col("o_orderdate") == F.col("_date"))
    return visits.join(bounded_broadcast(near, MAX_TIMES), same, "left").select(
        "o_orderkey", "c_nationkey", "o_orderdate", (F.col("within") - 1).alias("neighbours"))
