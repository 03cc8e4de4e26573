"""Streams against streams, and alerts from silence."""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator

from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from carebook.functions.columns import instant_to_ntz
from carebook.streaming.sink import drain_and_read
from carebook.streaming.source import EVENT_TIME, read_entries_table_stream

LATENESS = "1 hour"
ERROR, RESOLUTION = "error", "purchase"
WITHIN = "2 hours"
SILENCE_DAYS = 3
# The processor travels with the query, so workers need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def errors_resolved(errors: DataFrame, resolutions: DataFrame, lateness: str = LATENESS, within: str = WITHIN) -> DataFrame:
    """Each ``error`` entry with its person's first ``purchase`` at its time or up to ``within`` later.

    ``errors`` and ``resolutions`` are entry streams (one stream read twice, or two).
    Both are kept as state until the watermarks say that no partner can come: an
    error until purchases are past its time + ``within``, a purchase until errors
    are past its own time. An error then comes out with its matches, or with nulls.
    Matches of an error are folded to the first (by time, then ``event_id``) in a
    second stateful step, which holds one row per error, so an error comes out once,
    when its time is past. Late rows on either side are dropped. Errors without a
    person or a time come out with nulls, or not at all: no watermark passes a null.

    A person's rows of one ``within`` meet in one task, as in any equi-join on the
    person; state is bounded by what arrives within the watermarks.
    """
    e = (errors.where(F.col("event_type") == ERROR)
         .select("event_id", "user_id", F.col(EVENT_TIME).alias("error_time")).withWatermark("error_time", lateness))
    r = (resolutions.where(F.col("event_type") == RESOLUTION)
         .select(F.col("event_id").alias("resolution_id"), F.col("user_id").alias("_person"), F.col(EVENT_TIME).alias("resolution_time"))
         .withWatermark("resolution_time", lateness))
    same = ((F.col("user_id") == F.col("_person")) & (F.col("resolution_time") >= F.col("error_time"))
            & (F.col("resolution_time") <= F.col("error_time") + F.expr(f"INTERVAL {within}")))
    first = F.min(F.when(F.col("resolution_id").isNotNull(), F.struct("resolution_time", "resolution_id")))
    return (e.join(r, same, "left").groupBy("event_id", "user_id", "error_time").agg(first.alias("_first"))
            .select("event_id", "user_id", instant_to_ntz("error_time").alias("ts"), F.col("_first.resolution_id").alias("resolution_id"),
                    instant_to_ntz("_first.resolution_time").alias("resolution_ts")))


def errors_resolved_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stream: errors with the person's first purchase in the next 2 h (1 h watermarks), drained once."""
    return drain_and_read(spark, errors_resolved(read_entries_table_stream(spark, sf_dir), read_entries_table_stream(spark, sf_dir)),
                          "errors-resolved")


class SilenceAlerts(StatefulProcessor):
    """One person's stretches of entries, and a timer at the end of each stretch's silence.

    The one state value holds [first, last, first, last, ...] of the stretches that the
    watermark has not closed, in microseconds; two entries less than the silence
    apart are in one stretch. A row joins or starts a stretch whatever order rows
    come in; a timer whose stretch has grown since finds nothing to close.
    """

    def __init__(self, silence_micros: int):
        self._silence = silence_micros

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._stretches = handle.getValueState("stretches", "bounds array<bigint>")

    def _due(self, last: int) -> int:
        return math.ceil((last + self._silence) / 1000)  # timers are in milliseconds

    def handleInputRows(self, key, rows, timerValues) -> Iterator:
        held = self._bounds()
        stretches = list(held)
        for (at,) in ((r["at"],) for r in rows):
            near = [s for s in stretches if s[0] - self._silence < at < s[1] + self._silence]
            stretches = [s for s in stretches if s not in near]
            stretches.append((min([at, *(s[0] for s in near)]), max([at, *(s[1] for s in near)])))
        for last in {s[1] for s in held} - {s[1] for s in stretches}:
            self._handle.deleteTimer(self._due(last))
        for last in {s[1] for s in stretches} - {s[1] for s in held}:
            self._handle.registerTimer(self._due(last))
        self._keep(stretches)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator:
        now = expiredTimerInfo.getExpiryTimeInMs()
        stretches = self._bounds()
        over = [s for s in stretches if self._due(s[1]) <= now]
        self._keep([s for s in stretches if s not in over])
        return iter([Row(user_id=key[0], last=s[1]) for s in over])

    def close(self) -> None:
        pass

    def _bounds(self) -> list[tuple[int, int]]:
        flat = list(self._stretches.get()[0]) if self._stretches.exists() else []
        return list(zip(flat[::2], flat[1::2]))

    def _keep(self, stretches: list[tuple[int, int]]) -> None:
        if stretches:
            self._stretches.update(([x for s in sorted(stretches) for x in s],))
        else:
            self._stretches.clear()


def silent_persons(entries: DataFrame, lateness: str = LATENESS, silence_days: int = SILENCE_DAYS) -> DataFrame:
    """An alert for each person and entry after which ``silence_days`` of event time pass without another.

    ``silent_since`` is the person's last entry before the silence, ``alert_at`` that
    and ``silence_days``; the alert comes once the watermark (latest event time -
    ``lateness``) has reached it, whatever batches the entries came in. An entry
    exactly ``silence_days`` later comes after the silence. Entries without a person
    or a time are left out, late ones are dropped. State is one value per person with
    entries in the open period and lives in RocksDB (which timers need:
    ``spark.sql.streaming.stateStore.providerClass``). Timers of one's own need a
    stateful processor, and in this API that is Python: rows go to Python workers
    here, two numbers each.
    """
    silence = int(silence_days) * 86_400_000_000
    timed = (entries.where(F.col("user_id").isNotNull() & F.col(EVENT_TIME).isNotNull()).withWatermark(EVENT_TIME, lateness)
             .select("user_id", EVENT_TIME, F.unix_micros(EVENT_TIME).alias("at")))
    alerts = timed.groupBy("user_id").transformWithState(SilenceAlerts(silence), "user_id long, last long", "append", "eventTime")
    return alerts.select("user_id", instant_to_ntz(F.timestamp_micros("last")).alias("silent_since"),
                         instant_to_ntz(F.timestamp_micros(F.col("last") + silence)).alias("alert_at"))


def silent_person_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stream: persons without an entry for 3 days of event time (1 h watermark), drained once."""
    session = spark.newSession()  # timers need RocksDB; the caller's settings stay as they are
    session.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    return drain_and_read(spark, silent_persons(read_entries_table_stream(session, sf_dir)), "silent-persons")
