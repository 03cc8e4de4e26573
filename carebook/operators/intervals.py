"""Intervals and bands within a group, by counting along sorted times; no pair of rows is made."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carebook.functions.columns import ntz_micros
from carebook.operators.blocks import running_sums
from carebook.operators.broadcast import bounded_broadcast
from carebook.session import fresh_dir

MAX_GROUPS = 100_000


def open_counts(intervals: DataFrame, group: Sequence[str], start: str, end: str, parts: int | None = None) -> DataFrame:
    """(group, ``at``, ``open``): how many of the group's intervals [start, end) are open from ``at`` on, at
    each time at which one starts or ends.

    Starts count 1 and ends -1, summed per time before they are sorted. Intervals
    without a start or an end, or that end at or before their start, are never open.
    """
    edges = F.explode(F.array(F.struct(F.col(start).alias("at"), F.lit(1).alias("d")), F.struct(F.col(end).alias("at"), F.lit(-1).alias("d"))))
    changes = (intervals.where(F.col(start) < F.col(end)).select(*group, edges.alias("_edge"))
               .groupBy(*group, F.col("_edge.at").alias("at")).agg(F.sum("_edge.d").alias("_change")))
    return running_sums(changes, group, ["at"], {"open": "_change"}, parts).drop("_change")


def busiest_times(intervals: DataFrame, group: Sequence[str], start: str, end: str, parts: int | None = None) -> DataFrame:
    """Per group the most intervals open at once (``peak``), since when first (``peak_start``) and
    until when (``peak_end``, the next time at which fewer are open).

    The counts are written once. Peaks, one row a group, are broadcast to them up to
    MAX_GROUPS groups and joined by a shuffle, which AQE splits, beyond.
    """
    group = list(group)
    counts = open_counts(intervals, group, start, end, parts)
    path = fresh_dir(intervals.sparkSession, "open-counts")
    counts.write.parquet(path)
    counts = intervals.sparkSession.read.schema(counts.schema).parquet(path)
    first = F.min(F.struct((-F.col("open")).alias("less"), "at"))
    peaks = counts.groupBy(*group).agg(first.alias("_first")).select(
        *[F.col(g).alias(f"_peak_{i}") for i, g in enumerate(group)], (-F.col("_first.less")).alias("peak"), F.col("_first.at").alias("peak_start"))
    same = F.lit(True)
    for i, g in enumerate(group):
        same = same & F.col(g).eqNullSafe(F.col(f"_peak_{i}"))
    after = (F.col("at") > F.col("peak_start")) & (F.col("open") < F.col("peak"))
    return (counts.join(bounded_broadcast(peaks, MAX_GROUPS), same).groupBy(*group)
            .agg(F.first("peak").alias("peak"), F.first("peak_start").alias("peak_start"), F.min(F.when(after, F.col("at"))).alias("peak_end")))


def band_counts(rows: DataFrame, group: Sequence[str], ts: str, seconds: int, out: str, parts: int | None = None,
                weight: str | None = None) -> DataFrame:
    """(group, ``ts``, ``out``): for every distinct time of a group, its rows within ``seconds`` before or
    after, both ends and the row's own time included. Rows without a time are left out. A row
    counts once, or ``weight`` (a long column) times.

    Rows are counted per time first. Each time then asks the running count of its
    group at its two ends, so the work is three rows for each distinct time however
    many rows lie within the band.
    """
    group = list(group)
    width = int(seconds) * 1_000_000
    counts = (rows.where(F.col(ts).isNotNull()).groupBy(*group, ts).agg((F.sum(weight) if weight else F.count(F.lit(1))).alias("_n"))
              .withColumn("_tm", ntz_micros(ts)))

    def probe(kind: int, shift: int, n) -> F.Column:
        return F.struct(F.lit(kind).alias("kind"), (F.col("_tm") + shift).alias("tm"), n.cast("long").alias("n"))

    probes = F.explode(F.array(probe(0, -width, F.lit(0)), probe(1, 0, F.col("_n")), probe(2, width, F.lit(0))))
    asked = counts.select(*group, ts, probes.alias("_probe")).select(*group, ts, "_probe.*")
    upto = running_sums(asked, group, ["tm", "kind", ts], {"_upto": "n"}, parts)

    def at(kind: int) -> F.Column:
        return F.max(F.when(F.col("kind") == kind, F.col("_upto")))

    return upto.where(F.col("kind") != 1).groupBy(*group, ts).agg((at(2) - at(0)).alias(out))
