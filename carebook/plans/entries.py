"""Checks and filters on diary entries."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carebook.functions.columns import MONEY_BELOW, is_finite, json_attr, money, ntz
from carebook.sources.schemas import ENTRY_KINDS
from carebook.sources.tables import Tables

# Rule names of the quality report (fixed output values).
RULE_NULL_PERSON = "null_person"
RULE_NON_POSITIVE_VALUE = "non_positive_value"
RULE_UNKNOWN_PERSON = "unknown_person"
RULE_MISSING_ATTRIBUTE = "missing_attribute_k"
RULE_NULL_TIME = "null_time"
RULE_NULL_ID = "null_id"
RULE_NOT_FINITE = "not_finite_amount"
RULE_OUT_OF_RANGE = "out_of_range_amount"
RULE_SUB_CENT = "sub_cent_amount"
RULE_UNLISTED_KIND = "unlisted_kind"


def quality_report(events: DataFrame, persons: DataFrame) -> DataFrame:
    """One row per rule (``rule``, ``violations``) over ``events``.

    One scan: entries are counted per person and rule in a partial aggregate, so each map task ships
    one row per person. That per-person table is left-joined to the register
    keys once to flag unknown persons, and summed to one row. Entries with no
    person form the null group.
    """
    finite, small = is_finite("value"), F.abs("value") < MONEY_BELOW
    per_entry = {
        RULE_NON_POSITIVE_VALUE: F.col("value") <= 0,
        RULE_MISSING_ATTRIBUTE: json_attr("props", "k").isNull(),
        RULE_NULL_TIME: F.col("ts").isNull(),
        RULE_NULL_ID: F.col("event_id").isNull(),
        RULE_NOT_FINITE: F.col("value").isNotNull() & ~finite,
        RULE_OUT_OF_RANGE: finite & ~small,
        RULE_SUB_CENT: finite & small & (money("value").cast("double") != F.col("value")),
        RULE_UNLISTED_KIND: ~F.coalesce(F.col("event_type").isin(ENTRY_KINDS), F.lit(False)),
    }
    per_person = events.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("n"), *[F.count_if(broken).alias(rule) for rule, broken in per_entry.items()])
    known = persons.select(F.col("c_custkey").alias("user_id")).distinct().withColumn("known", F.lit(True))
    flagged = per_person.join(known, "user_id", "left")
    unknown = F.col("user_id").isNotNull() & F.col("known").isNull()
    totals = flagged.agg(
        F.sum(F.when(F.col("user_id").isNull(), F.col("n")).otherwise(0)).alias(RULE_NULL_PERSON),
        F.sum(F.when(unknown, F.col("n")).otherwise(0)).alias(RULE_UNKNOWN_PERSON),
        *[F.sum(rule).alias(rule) for rule in per_entry],
    )
    rules = [RULE_NULL_PERSON, RULE_UNKNOWN_PERSON, *per_entry]
    return totals.select([F.coalesce(F.col(r), F.lit(0)).cast("long").alias(r) for r in rules]).unpivot(
        [], rules, "rule", "violations")


def diary_quality_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Violations per rule: entries without a person, time, id or ``$.k``, persons
    not in the register, kinds not in the list, and amounts that are not positive,
    not finite, out of range or finer than a cent (the middle two are in no sum)."""
    t = Tables(spark, sf_dir)
    return quality_report(t.events, t.customer)


def entries_between(events: DataFrame, start: dt.datetime, end: dt.datetime) -> DataFrame:
    """Entries with ``start <= ts < end`` (pushed to the parquet scan)."""
    return events.where((F.col("ts") >= ntz(start)) & (F.col("ts") < ntz(end)))


def diary_entries_between(spark: SparkSession, sf_dir: str,
                          start: dt.datetime = dt.datetime(2024, 1, 10),
                          end: dt.datetime = dt.datetime(2024, 1, 20)) -> DataFrame:
    """Entries with 2024-01-10 <= ts < 2024-01-20 (by default)."""
    return entries_between(Tables(spark, sf_dir).events, start, end)


def attribute_counts(spark: SparkSession, sf_dir: str, attribute: str = "k") -> DataFrame:
    """Entries per value of one JSON attribute of ``props`` (as int; null when absent)."""
    e = Tables(spark, sf_dir).events
    return (e.select(json_attr("props", attribute).try_cast("int").alias(attribute))
            .groupBy(attribute).agg(F.count(F.lit(1)).alias("entries")))
