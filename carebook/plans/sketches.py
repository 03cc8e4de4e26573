"""Distinct persons and quantiles of amounts of any period, from sketches stored per day."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carebook.functions.columns import day_of, is_finite
from carebook.operators import daily_state
from carebook.operators.broadcast import bounded_broadcast
from carebook.plans.register import PERIOD_END, PERIOD_START
from carebook.session import fresh_dir
from carebook.sources.schemas import MAX_DISTRICTS
from carebook.sources.tables import Tables

PERSON_LG_K = 14         # 16,384 registers: a standard error of 0.8 %
PERSON_TOLERANCE = 0.03
AMOUNT_K = 800           # rank error of 0.4 % with a confidence of 99 %
AMOUNT_TOLERANCE = 0.01
QUANTILES = (0.05, 0.25, 0.5, 0.75, 0.95)
SECOND_HALF = dt.date(2024, 1, 15)
MAX_ESTIMATES = 10_000

_PERSON_STATE = "c_nationkey int, persons binary, day date"
_AMOUNT_STATE = "event_type string, amounts binary, day date"


def _schema(ddl: str):
    from pyspark.sql.types import StructType
    return StructType.fromDDL(ddl)


def extend_person_sketches(spark: SparkSession, sf_dir: str, store: str, start: dt.date | None = None, end: dt.date | None = None) -> None:
    """Add the days in [start, end) to ``store``: per day and district a sketch of the persons with entries.

    Entries are reduced to distinct (day, person) before the register join, and each
    task folds its persons into one sketch per day and district before the shuffle.
    """
    t = Tables(spark, sf_dir)
    seen = daily_state.between(t.events.select(day_of("ts").alias("day"), "user_id"), start, end).where(F.col("user_id").isNotNull()).distinct()
    persons = t.customer.where(F.col("c_nationkey").isNotNull()).select("c_custkey", "c_nationkey")
    sketches = seen.join(persons, F.col("user_id") == F.col("c_custkey")).groupBy("c_nationkey", "day").agg(
        F.hll_sketch_agg("user_id", PERSON_LG_K).alias("persons"))
    daily_state.extend(sketches, store)


def period_persons(spark: SparkSession, store: str, start: dt.date | None = None, end: dt.date | None = None) -> DataFrame:
    """(c_nationkey, persons): estimated distinct persons of each district in [start, end), from the stored days alone."""
    days = daily_state.read(spark, store, _schema(_PERSON_STATE), start, end)
    return days.groupBy("c_nationkey").agg(F.hll_sketch_estimate(F.hll_union_agg("persons")).alias("persons"))


def period_persons_sketch(spark: SparkSession, sf_dir: str, start: dt.date = PERIOD_START.date(), end: dt.date = PERIOD_END.date(),
                          store: str | None = None) -> DataFrame:
    """Per district the distinct persons with entries in [2024-01-10, 2024-01-20), exactly, and whether the
    estimate from stored day sketches is within 3 % of that.

    The store is built in two steps, the second of which extends the first. Persons
    without an entry, unknown ones and entries without a time count nowhere.
    """
    store = store or fresh_dir(spark, "person-sketches")
    extend_person_sketches(spark, sf_dir, store, end=SECOND_HALF)
    extend_person_sketches(spark, sf_dir, store, start=SECOND_HALF)
    t = Tables(spark, sf_dir)
    seen = daily_state.between(t.events.select(day_of("ts").alias("day"), "user_id"), start, end).select("user_id").distinct()
    exact = seen.join(t.customer.select("c_custkey", "c_nationkey"), F.col("user_id") == F.col("c_custkey")).groupBy("c_nationkey").agg(
        F.count(F.lit(1)).alias("exact"))
    names = bounded_broadcast(t.nation.select("n_nationkey", "n_name"), MAX_DISTRICTS)
    near = F.abs(F.col("persons") - F.col("exact")) <= PERSON_TOLERANCE * F.col("exact")
    return (exact.join(period_persons(spark, store, start, end), "c_nationkey", "left").join(names, F.col("c_nationkey") == F.col("n_nationkey"))
            .select("n_nationkey", "n_name", F.col("exact").alias("persons"), F.coalesce(near, F.lit(False)).alias("estimate_is_near")))


def _amounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Tables(spark, sf_dir).events.where(is_finite("value")).select(day_of("ts").alias("day"), "event_type", "value")


def extend_amount_sketches(spark: SparkSession, sf_dir: str, store: str, start: dt.date | None = None, end: dt.date | None = None) -> None:
    """Add the days in [start, end) to ``store``: per day and kind a sketch of the amounts (null, NaN and infinite ones left out)."""
    days = daily_state.between(_amounts(spark, sf_dir), start, end)
    daily_state.extend(days.groupBy("event_type", "day").agg(F.kll_sketch_agg_double("value", F.lit(AMOUNT_K)).alias("amounts")), store)


def period_amount_quantiles(spark: SparkSession, store: str, start: dt.date | None = None, end: dt.date | None = None,
                            quantiles: tuple[float, ...] = QUANTILES) -> DataFrame:
    """(event_type, quantile, estimate): amounts of each kind at the given quantiles in [start, end), from the stored days alone."""
    days = daily_state.read(spark, store, _schema(_AMOUNT_STATE), start, end)
    merged = days.groupBy("event_type").agg(F.kll_merge_agg_double("amounts", F.lit(AMOUNT_K)).alias("amounts"))
    at = F.explode(F.array(*[F.struct(F.lit(float(q)).alias("quantile"), F.kll_sketch_get_quantile_double("amounts", F.lit(float(q))).alias("estimate"))
                             for q in quantiles]))
    return merged.select("event_type", at.alias("_at")).select("event_type", "_at.quantile", "_at.estimate")


def amount_quantiles_sketch(spark: SparkSession, sf_dir: str, store: str | None = None) -> DataFrame:
    """Per kind and quantile, over all days: the number of amounts, and whether the exact rank of the
    estimate from stored day sketches is within 0.01 of the quantile.

    An estimate's exact ranks reach from the share of smaller amounts to that of
    amounts not larger. Amounts that are null, NaN or infinite, and entries without a
    time, are in no sketch and not counted. Entries without a kind are a kind.
    """
    store = store or fresh_dir(spark, "amount-sketches")
    extend_amount_sketches(spark, sf_dir, store, end=SECOND_HALF)
    extend_amount_sketches(spark, sf_dir, store, start=SECOND_HALF)
    estimates = period_amount_quantiles(spark, store).select(F.col("event_type").alias("_kind"), "quantile", "estimate")
    amounts = daily_state.between(_amounts(spark, sf_dir), None, None).select("event_type", "value")
    # Amounts that agree are one row before they meet the few estimates of their kind.
    counted = amounts.groupBy("event_type", "value").agg(F.count(F.lit(1)).alias("_n"))
    placed = counted.join(bounded_broadcast(estimates, MAX_ESTIMATES), F.col("event_type").eqNullSafe(F.col("_kind")))
    ranks = placed.groupBy("event_type", "quantile").agg(
        F.sum("_n").alias("amounts"), F.sum(F.when(F.col("value") < F.col("estimate"), F.col("_n")).otherwise(0)).alias("_below"),
        F.sum(F.when(F.col("value") <= F.col("estimate"), F.col("_n")).otherwise(0)).alias("_upto"))
    near = ((F.col("_below") / F.col("amounts") <= F.col("quantile") + AMOUNT_TOLERANCE)
            & (F.col("_upto") / F.col("amounts") >= F.col("quantile") - AMOUNT_TOLERANCE))
    return ranks.select("event_type", "quantile", "amounts", near.alias("rank_is_near"))
