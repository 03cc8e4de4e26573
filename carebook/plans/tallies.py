"""Tallies of services and workload (aggregation, rollup, pivot)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carebook.functions.columns import cents, day_of, exact_sum
from carebook.operators.broadcast import bounded_broadcast
from carebook.plans.register import districts
from carebook.sources.schemas import ENTRY_KINDS, MAX_DISTRICTS
from carebook.sources.tables import Tables


def person_day_services(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per person, day and kind of care: entries and exact sum of ``value``."""
    e = Tables(spark, sf_dir).events
    return e.groupBy("user_id", day_of("ts").alias("day"), "event_type").agg(
        F.count(F.lit(1)).alias("entries"), exact_sum("value").alias("total_value"))


def worker_month_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per worker and calendar month of the visit: distinct visits, distinct
    persons, exact sum of service quantity.

    Lines are first summed per (visit, worker), before the join: a visit that
    holds a huge share of the lines becomes one row per worker in every map
    task, and no aggregate relies on the join's partitioning, so AQE can split
    that visit's join partition under its default settings. It also removes the
    repeated lines, so the month aggregate needs ``count(*)`` for visits and only
    one distinct count (persons), which Spark plans without the 2x ``Expand`` of
    two distinct aggregates.

    The distinct-persons count shuffles twice: by (worker, month, person),
    then, after a partial count, by (worker, month). One shuffle by (worker,
    month) would do, but it would ship unreduced rows, so a busy worker-month
    would land whole in one task; this way it leaves each task as one row.
    """
    t = Tables(spark, sf_dir)
    lines = (t.lineitem.select("l_orderkey", "l_suppkey", cents("l_quantity").alias("q"))
             .groupBy("l_orderkey", "l_suppkey").agg(F.sum("q").alias("q")))
    # Year and month travel as one key, yyyymm: narrower hash keys in both
    # large aggregates; they are split again on the small result.
    visits = t.orders.select("o_orderkey", "o_custkey",
                             (F.year("o_orderdate") * 100 + F.month("o_orderdate")).alias("ym"))
    per_visit = lines.join(visits, F.col("l_orderkey") == F.col("o_orderkey"), "inner")
    return per_visit.groupBy("l_suppkey", "ym").agg(
        F.count(F.lit(1)).alias("visits"),
        F.count_distinct("o_custkey").alias("persons"),
        (F.sum("q") / 100).alias("quantity"),
    ).select("l_suppkey", F.expr("ym div 100").cast("long").alias("year"),
             (F.col("ym") % 100).cast("long").alias("month"), "visits", "persons", "quantity")


def _entries_per_district(t: Tables) -> DataFrame:
    """Entry counts per district, counted per person first.

    Counting per person before the register join means the join shuffles one
    row per person, not one per entry, and reuses the count's partitioning.
    """
    per_person = t.events.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
    persons = t.customer.select("c_custkey", "c_nationkey")
    return (per_person.join(persons, F.col("user_id") == F.col("c_custkey"), "inner")
            .groupBy("c_nationkey").agg(F.sum("n").alias("n")))


def district_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entries by area and district with area subtotals and a grand total.

    ``grouping_level`` is ``grouping_id(r_name, n_name)``: 0 district row,
    1 area subtotal, 3 grand total. The rollup runs on one row per district.
    """
    t = Tables(spark, sf_dir)
    dist = bounded_broadcast(districts(t), MAX_DISTRICTS)
    return (
        _entries_per_district(t).join(dist, F.col("c_nationkey") == F.col("n_nationkey"), "inner")
        .rollup("r_name", "n_name")
        .agg(F.sum("n").cast("long").alias("entries"),
             F.grouping_id("r_name", "n_name").cast("long").alias("grouping_level"))
    )


def district_by_kind(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per district, one count column per kind of care (0 if none), and
    ``other`` for entries of no kind or one not in the list; the columns add up
    to the district's entries.

    The pivot runs at the person grain over the fixed kind list, as one
    conditional count per kind in a single aggregate. ``GroupedData.pivot``
    would first aggregate per (person, kind) and then pivot per person, one
    more shuffle for the same columns. The result has one row per person,
    hash-partitioned by person, which the register join reuses; the district
    aggregate then adds up six columns.
    """
    t = Tables(spark, sf_dir)
    listed = F.coalesce(F.col("event_type").isin(ENTRY_KINDS), F.lit(False))
    per_person = t.events.groupBy("user_id").agg(
        *[F.count_if(F.col("event_type") == k).alias(k) for k in ENTRY_KINDS], F.count_if(~listed).alias("other"))
    columns = [*ENTRY_KINDS, "other"]
    persons = t.customer.select("c_custkey", "c_nationkey")
    counts = (per_person.join(persons, F.col("user_id") == F.col("c_custkey"), "inner")
              .groupBy("c_nationkey").agg(*[F.sum(k).alias(k) for k in columns]))
    names = t.nation.select("n_nationkey", "n_name")
    return names.join(counts, F.col("n_nationkey") == F.col("c_nationkey"), "left").select(
        "n_nationkey", "n_name", *[F.coalesce(F.col(k), F.lit(0)).cast("long").alias(k) for k in columns])


def same_day_visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(person, day) pairs with more than one visit, and how many (HAVING)."""
    o = Tables(spark, sf_dir).orders
    return (o.groupBy("o_custkey", day_of("o_orderdate").alias("visit_day"))
            .agg(F.count(F.lit(1)).alias("visits"))
            .where(F.col("visits") > 1))


def weekly_sliding_tally(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entries per kind in every 7-day window, one window starting each day.

    Entries are counted per (day, kind) first; ``window`` then expands those
    daily counts (not every entry) into their 7 windows. Day-aligned windows
    contain whole days, so summing daily counts per window is exact, and the
    expand works on a table bounded by days x kinds. Entries without a time
    are in no window.
    """
    e = Tables(spark, sf_dir).events
    daily = e.groupBy(F.to_date("ts").cast("timestamp_ntz").alias("day"), "event_type").agg(
        F.count(F.lit(1)).alias("n"))
    return (daily.groupBy(F.window("day", "7 days", "1 day").alias("w"), "event_type")
            .agg(F.sum("n").cast("long").alias("entries"))
            .select(F.to_date("w.start").alias("window_start"), F.to_date("w.end").alias("window_end"),
                    "event_type", "entries"))
