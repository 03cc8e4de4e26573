"""Diary entries against the population register (joins)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carebook.functions.columns import ntz
from carebook.operators.broadcast import bounded_broadcast
from carebook.sources.schemas import MAX_DISTRICTS
from carebook.sources.tables import Tables


def districts(t: Tables) -> DataFrame:
    """District with its area (nation x region, two closed lists).

    Callers broadcast the result behind one size check of the joined table,
    which bounds it however the two small tables were joined.
    """
    region = t.region.select("r_regionkey", "r_name")
    return t.nation.select("n_nationkey", "n_name", "n_regionkey").join(
        region, F.col("n_regionkey") == F.col("r_regionkey"), "inner").drop("n_regionkey")


def register(t: Tables) -> DataFrame:
    """Person with district and area.

    The register grows with the population, so it is never hinted for
    broadcast; only the district table is (its size is checked).
    """
    dist = bounded_broadcast(districts(t), MAX_DISTRICTS)
    return t.customer.select("c_custkey", "c_name", "c_nationkey").join(
        dist, F.col("c_nationkey") == F.col("n_nationkey"), "inner").drop("c_nationkey")


def diary_enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each entry with its person, district and area (inner join).

    Entries x register is a shuffle join on the person key; a person with a
    third of all entries is a skewed partition that AQE's skew-join rule splits
    (the register side of that partition is replicated, not the entries).
    """
    t = Tables(spark, sf_dir)
    e = t.events.select("event_id", "ts", "user_id", "event_type", "value")
    return e.join(register(t), F.col("user_id") == F.col("c_custkey"), "inner").drop("c_custkey")


def _persons_seen(t: Tables) -> DataFrame:
    # Distinct first: the partial aggregate collapses each person's entries to
    # one row per map task before the shuffle, so a busy person costs nothing.
    return t.events.select(F.col("user_id").alias("c_custkey")).where(
        F.col("c_custkey").isNotNull()).distinct()


def persons_with_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Persons of the register with at least one entry (left semi join)."""
    t = Tables(spark, sf_dir)
    return t.customer.select("c_custkey", "c_name", "c_nationkey").join(
        _persons_seen(t), "c_custkey", "left_semi")


def persons_without_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Persons of the register with no entry at all (left anti join)."""
    t = Tables(spark, sf_dir)
    return t.customer.select("c_custkey", "c_name", "c_nationkey").join(
        _persons_seen(t), "c_custkey", "left_anti")


def visits_without_services(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Visits with no service line (left anti join on distinct visit keys)."""
    t = Tables(spark, sf_dir)
    served = t.lineitem.select(F.col("l_orderkey").alias("o_orderkey")).where(
        F.col("o_orderkey").isNotNull()).distinct()
    return t.orders.select("o_orderkey", "o_custkey", "o_orderdate").join(served, "o_orderkey", "left_anti")


# Reporting period of the flagship report (half-open).
PERIOD_START = dt.datetime(2024, 1, 10)
PERIOD_END = dt.datetime(2024, 1, 20)


def district_entries_between(spark: SparkSession, sf_dir: str, start: dt.datetime = PERIOD_START,
                             end: dt.datetime = PERIOD_END) -> DataFrame:
    """Flagship: how many entries of each kind each district recorded in [start, end).

    The period filter reaches the parquet scan. Entries are counted per
    (person, kind) before the register join, so the join and the second
    aggregate see one row per person and kind instead of one per entry.
    """
    t = Tables(spark, sf_dir)
    per_person = (
        t.events.where((F.col("ts") >= ntz(start)) & (F.col("ts") < ntz(end)))
        .groupBy("user_id", "event_type").agg(F.count(F.lit(1)).alias("n"))
    )
    persons = t.customer.select("c_custkey", "c_nationkey")
    per_district = (
        per_person.join(persons, F.col("user_id") == F.col("c_custkey"), "inner")
        .groupBy("c_nationkey", "event_type").agg(F.sum("n").cast("long").alias("entries"))
    )
    names = bounded_broadcast(t.nation.select("n_nationkey", "n_name"), MAX_DISTRICTS)
    return per_district.join(names, F.col("c_nationkey") == F.col("n_nationkey"), "inner").select(
        "n_nationkey", "n_name", "event_type", "entries")
