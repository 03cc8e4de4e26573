"""Structured Streaming jobs over arriving diary entries.

Each ``*_stream(spark, sf_dir)`` drains the folder's entries once with
``trigger(availableNow=True)`` into parquet under the shared checkpoint root
and returns the committed output. The transformations (``daily_tally``,
``dedup_entries``, ``closed_episodes``) and ``start_enrich`` take any entry
stream, so the same code runs as a long-lived query.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from carebook.functions.columns import instant_day, instant_to_ntz
from carebook.plans.register import register
from carebook.session import fresh_dir
from carebook.sources.tables import Tables
from carebook.streaming.register_copy import RegisterCopy
from carebook.streaming.sink import drain_and_read, finish, read_batches, start_batches
from carebook.streaming.source import EVENT_TIME, read_entries_table_stream

LATENESS = "1 hour"
EPISODE_GAP = "2 hours"
DEDUP_LANES = 32
MATCHED = "matched"


def daily_tally(entries: DataFrame, lateness: str = LATENESS) -> DataFrame:
    """Entries per day and kind. A day is emitted once the watermark (latest
    event time - ``lateness``) passes its end; a row that arrives after its
    day was closed is dropped (Spark checks late rows against the previous
    micro-batch's watermark). The partial aggregate folds each micro-batch per
    task before the state-store shuffle."""
    return (entries.withWatermark(EVENT_TIME, lateness)
            .groupBy(F.window(EVENT_TIME, "1 day").alias("w"), "event_type")
            .agg(F.count(F.lit(1)).alias("entries"))
            .select(instant_day("w.start").alias("day"), "event_type", "entries"))


def dedup_entries(entries: DataFrame, lateness: str = LATENESS, lanes: int = DEDUP_LANES) -> DataFrame:
    """Drop redelivered ``event_id``s seen within the watermark; state for an
    id expires once the watermark passes its first delivery + ``lateness``.
    Entries without an id cannot be told from copies and all pass.

    ``dropDuplicatesWithinWatermark`` sends an id's copies to one task. So copies are
    dropped twice: within their lane (the number of the task that read them, modulo
    ``lanes``) and then over all lanes, where an id comes at most ``lanes`` times in
    ``lateness``, however often it is redelivered. A source's micro-batch is cut into the same tasks when it is
    run again, so a lost task finds the same lanes; after a shuffle of the entries that
    would not hold: give ``lanes=1`` then, which is one step. State is one row per id in each step.
    A copy that comes after its id's state has expired passes, unless its lane still
    holds a later copy.
    """
    timed = entries.withWatermark(EVENT_TIME, lateness)
    known = timed.where(F.col("event_id").isNotNull())
    if lanes > 1:
        known = (known.withColumn("_lane", F.spark_partition_id() % lanes)
                 .dropDuplicatesWithinWatermark(["event_id", "_lane"]).drop("_lane"))
    return (known.dropDuplicatesWithinWatermark(["event_id"])
            .unionByName(timed.where(F.col("event_id").isNull())).drop(EVENT_TIME))


def dedup_entries_combined(entries: DataFrame, lateness: str = LATENESS) -> DataFrame:
    """Drop redelivered entries with map-side combining, for ids that may be
    redelivered massively.

    ``dropDuplicatesWithinWatermark`` sends every copy of an id to one task.
    Here copies are grouped by (``event_id``, event time) in a streaming
    aggregation, whose partial aggregate collapses them to one row per task
    before the state shuffle. The price: an entry is emitted only once the
    watermark passes its event time, and copies must carry the same ``ts``
    (as redelivered records do). Of copies that differ elsewhere, the smallest
    record is kept, whole. Entries without an id all pass, at once.
    """
    rest = [c for c in entries.columns if c not in ("event_id", EVENT_TIME)]
    timed = entries.withWatermark(EVENT_TIME, lateness)
    return (timed.where(F.col("event_id").isNotNull()).groupBy("event_id", EVENT_TIME)
            .agg(F.min(F.struct(*rest)).alias("_entry"))
            .select("event_id", *[F.col(f"_entry.{c}").alias(c) for c in rest])
            .unionByName(timed.where(F.col("event_id").isNull()).select("event_id", *rest)))


def enrich(entries: DataFrame, register_df: DataFrame) -> DataFrame:
    """Entries with person, district and area, and ``matched``: whether the
    person is in the register. An entry that is not matched keeps nulls there."""
    e = entries.select("event_id", "ts", "user_id", "event_type", "value")
    return (e.join(register_df, F.col("user_id") == F.col("c_custkey"), "left")
            .withColumn(MATCHED, F.col("c_custkey").isNotNull()).drop("c_custkey"))


def closed_episodes(entries: DataFrame, lateness: str = LATENESS, gap: str = EPISODE_GAP) -> DataFrame:
    """Episodes (``session_window`` with a 2 h gap) per person, emitted once
    closed: when the watermark passes the last entry + gap. With
    ``spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition``
    sessions are merged in each task before the shuffle."""
    return (entries.withWatermark(EVENT_TIME, lateness)
            .groupBy("user_id", F.session_window(EVENT_TIME, gap).alias("s"))
            .agg(F.count(F.lit(1)).alias("entries"))
            .select("user_id", instant_to_ntz("s.start").alias("episode_start"),
                    instant_to_ntz("s.end").alias("episode_end"), "entries"))


def daily_tally_stream(spark: SparkSession, sf_dir: str, out_dir: str | None = None, checkpoint_dir: str | None = None,
                       **limits) -> DataFrame:
    """Stream: entries per closed day and kind (1 h watermark), drained once (folders and limits: ``drain_and_read``)."""
    return drain_and_read(spark, daily_tally(read_entries_table_stream(spark, sf_dir, **limits)), "daily-tally", out_dir, checkpoint_dir)


def dedup_entries_stream(spark: SparkSession, sf_dir: str, out_dir: str | None = None, checkpoint_dir: str | None = None,
                         **limits) -> DataFrame:
    """Stream: entries without redelivered ids (1 h watermark), drained once (folders and limits: ``drain_and_read``)."""
    return drain_and_read(spark, dedup_entries(read_entries_table_stream(spark, sf_dir, **limits)), "dedup-entries", out_dir, checkpoint_dir)


def start_enrich(spark: SparkSession, base_dir: str, entries: DataFrame, out_dir: str, checkpoint_dir: str,
                 **trigger) -> StreamingQuery:
    """Start enriching an entry stream into ``out_dir``.

    The register is kept bucketed by person and copied anew when its files change
    (``RegisterCopy``), so a micro-batch shuffles its own rows and never the register, and
    a person registered while the query runs is found from the next batch on. Entries of persons not in the
    register are written too, apart from the others (see ``read_batches``), so
    they can be enriched later (``late_matches``); none is lost.
    """
    copy = RegisterCopy(spark, base_dir)
    return start_batches(spark, entries, lambda batch: enrich(batch, copy.persons_of(batch)), MATCHED, out_dir, checkpoint_dir, **trigger)


def late_matches(spark: SparkSession, base_dir: str, out_dir: str) -> DataFrame:
    """Entries written as unmatched whose person is in the register by now, enriched."""
    left = read_batches(spark, out_dir, _enriched_schema(spark, base_dir), MATCHED, False)
    return enrich(left, register(Tables(spark, base_dir))).where(MATCHED).drop(MATCHED)


def _enriched_schema(spark: SparkSession, base_dir: str) -> StructType:
    t = Tables(spark, base_dir)
    return enrich(t.events, register(t)).schema


def enrich_stream(spark: SparkSession, sf_dir: str, out_dir: str | None = None) -> DataFrame:
    """Stream: entries with person, district and area, drained once (entries not in the register: ``read_batches``)."""
    out_dir = out_dir or fresh_dir(spark, "enrich-out")
    finish(start_enrich(spark, sf_dir, read_entries_table_stream(spark, sf_dir), out_dir,
                        fresh_dir(spark, "enrich-checkpoint"), available_now=True))
    return read_batches(spark, out_dir, _enriched_schema(spark, sf_dir), MATCHED, True)


def episodes_stream(spark: SparkSession, sf_dir: str, out_dir: str | None = None, checkpoint_dir: str | None = None,
                    **limits) -> DataFrame:
    """Stream: closed episodes of care (2 h gap, 1 h watermark), drained once (folders and limits: ``drain_and_read``).

    Only open sessions are state: with a limit, and files that arrive in time order,
    those of the last micro-batches instead of the whole table's.
    """
    return drain_and_read(spark, closed_episodes(read_entries_table_stream(spark, sf_dir, **limits)), "episodes", out_dir, checkpoint_dir)


# Transformations for long-running queries (python -m carebook stream ...):
# name -> (spark, base_dir, entry_stream) -> stream to append.
TRANSFORMS = {
    "daily_tally": lambda spark, base_dir, entries: daily_tally(entries),
    "dedup_entries": lambda spark, base_dir, entries: dedup_entries(entries),
    "dedup_entries_combined": lambda spark, base_dir, entries: dedup_entries_combined(entries),
    "closed_episodes": lambda spark, base_dir, entries: closed_episodes(entries),
}
