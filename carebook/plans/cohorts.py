"""Cohorts of persons compared across two periods (set operations)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carebook.functions.columns import ntz
from carebook.sources.tables import Tables

EARLY_BEFORE = dt.datetime(2024, 1, 2)
LATE_FROM = dt.datetime(2024, 1, 30)


def _persons(events: DataFrame, cond) -> DataFrame:
    # Distinct per side first: each side's partial aggregate collapses a busy
    # person to one row per map task. Entries without a person belong to no
    # cohort and are dropped.
    return events.where(cond & F.col("user_id").isNotNull()).select("user_id").distinct()


def _periods(spark: SparkSession, sf_dir: str, early_before: dt.datetime, late_from: dt.datetime):
    e = Tables(spark, sf_dir).events
    return (_persons(e, F.col("ts") < ntz(early_before)),
            _persons(e, F.col("ts") >= ntz(late_from)))


# Both sides are distinct, non-null person keys, so EXCEPT DISTINCT and
# INTERSECT DISTINCT are exactly a left anti and a left semi join on the key.
# ``subtract`` / ``intersect`` would plan the same joins on a null-safe key
# (coalesce(key), isnull(key)) and shuffle both distinct sides a second time;
# the plain equi-join reuses the hash partitioning of the two distincts.


def lapsed_persons(spark: SparkSession, sf_dir: str, early_before: dt.datetime = EARLY_BEFORE,
                   late_from: dt.datetime = LATE_FROM) -> DataFrame:
    """Persons with an entry before ``early_before`` and none from ``late_from`` on (EXCEPT)."""
    early, late = _periods(spark, sf_dir, early_before, late_from)
    return early.join(late, "user_id", "left_anti")


def retained_persons(spark: SparkSession, sf_dir: str, early_before: dt.datetime = EARLY_BEFORE,
                     late_from: dt.datetime = LATE_FROM) -> DataFrame:
    """Persons with entries before ``early_before`` and from ``late_from`` on (INTERSECT)."""
    early, late = _periods(spark, sf_dir, early_before, late_from)
    return early.join(late, "user_id", "left_semi")
