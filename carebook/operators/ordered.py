"""Per-person ordered scans that never put one person's history in one task.

A plain ``Window.partitionBy(person).orderBy(ts)`` sends every entry of a
person to a single task. If one person holds a third of the diary, that task
holds a third of the data. The operators here split each person's timeline
into time buckets (a day by default, ``bucket_seconds`` to choose finer) and
work in two levels:

1. Row level: windows partitioned by (person, bucket). A task never holds
   more than one person-bucket of rows.
2. Bucket level: a summary with one row per person-bucket (its last row, its
   total, its count), scanned per person. Its size per person is bounded by
   the calendar span / bucket width, not by the number of entries.

The day-level result is brought back to the rows as *carry rows*: extra rows
unioned into the row-level input, keyed by (person, day) and sorted before the
day's own rows. The union shares the one shuffle the row-level window needs
anyway, so there is no join back and no second pass over the big input.

Every expression is deterministic (no random salt, no partition ids), so a
lost executor's tasks recompute the same rows.

Cost: one carry row per key and bucket after the key's first, plus the
bucket-level summary (a sort-based aggregate when it keeps a whole last row).
For dense keys (many rows per bucket) that is small. For sparse keys (about
one row per bucket, like visits per customer-day) the window shuffle nearly
doubles: ``visit_gaps`` on 4.5M visits took 8.2-8.5 s bucketed against
2.3-2.8 s for a plain per-person window (local[8]). With ``plain_below``, all
three operators therefore cut only hot keys (more rows than that) into buckets.
The hot keys are counted once, written to the shared folder and joined
null-safe, so rows without a person are a hot key like any other. A table with no
more rows than that in all (for Parquet, its footers say so) has none and is
not counted by key.

``previous_in_order`` cuts hot keys by range of their order itself
(``operators.blocks``), so neither a full day nor any other value of the order
short of the whole of it is a window of its own. The other two need buckets of
known width in time; rows without a time have none and are summed apart, cut by range
of the tie-break.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from carebook.functions.columns import cents, ntz_micros, time_bucket
from carebook.operators.blocks import BLOCK, running_sums, sorted_blocks
from carebook.operators.broadcast import bounded_broadcast
from carebook.session import fresh_dir

BUCKET = "_bucket"
HOT = "_hot"
HALVINGS = "_halvings"
MAX_HALVINGS = 10  # a day becomes buckets of 84 seconds at least
KIND = "_row_kind"  # 0: carry row, 1: real row, 2: shadow row (see trailing counts)

_UNBOUNDED_PRECEDING = Window.unboundedPreceding
_CURRENT = Window.currentRow


def _interval_seconds(seconds: int) -> Column:
    return F.expr(f"INTERVAL {int(seconds)} SECONDS")


def _hot_keys(df: DataFrame, key: list, plain_below: int, max_hot_keys: int,
              slot: Column | None, most_halvings: int) -> DataFrame | None:
    """The keys with more than ``plain_below`` rows, or None if there are none,
    with HALVINGS: how often the slot width is to be halved so that the key's
    fullest slot, spread evenly, has about ``plain_below`` rows a bucket.

    Counted once, when the plan is built (one aggregate over the key columns),
    and written to the shared folder, so no plan counts them again. Broadcast
    only while there are at most ``max_hot_keys``; beyond that the list is
    joined without a hint. A null key is a key like any other.
    """
    if df.count() <= plain_below:
        return None
    if slot is None:
        counts = df.groupBy(*key).agg(F.count(F.lit(1)).alias("_n"), F.lit(0).alias(HALVINGS))
    else:
        over = F.ceil(F.log2(F.max("_m") / max(1, plain_below)))
        counts = (df.groupBy(*key, slot.alias("_slot")).agg(F.count(F.lit(1)).alias("_m")).groupBy(*key)
                  .agg(F.sum("_m").alias("_n"), F.least(F.greatest(over, F.lit(0)), F.lit(most_halvings)).cast("int").alias(HALVINGS)))
    hot = counts.where(F.col("_n") > plain_below).select(
        *[F.col(k).alias(f"_hot_key_{i}") for i, k in enumerate(key)], F.lit(True).alias(HOT), HALVINGS)
    path = fresh_dir(df.sparkSession, "hot-keys")
    hot.write.parquet(path)
    listed = df.sparkSession.read.schema(hot.schema).parquet(path)
    return bounded_broadcast(listed, max_hot_keys) if listed.limit(1).count() else None


def _flag_hot(df: DataFrame, key: list, plain_below: int | None, max_hot_keys: int,
              slot: Column | None = None, most_halvings: int = 0) -> DataFrame | None:
    """``df`` with HOT (true or null) and HALVINGS, or None if no key is hot. Without a threshold every key is."""
    if plain_below is None:
        return df.withColumns({HOT: F.lit(True), HALVINGS: F.lit(0)})
    hot = _hot_keys(df, key, plain_below, max_hot_keys, slot, most_halvings)
    if hot is None:
        return None
    same = [F.col(k).eqNullSafe(F.col(f"_hot_key_{i}")) for i, k in enumerate(key)]
    return df.join(hot, reduce(and_, same), "left").drop(*[f"_hot_key_{i}" for i in range(len(key))])


def flag_hot_in_time(df: DataFrame, key: list, ts: str, bucket_seconds: int, plain_below: int | None,
                      max_hot_keys: int) -> DataFrame | None:
    """``df`` with HOT and, for hot keys, BUCKET: the start of the row's time
    bucket in microseconds; None if no key is hot. A key with very full buckets
    gets narrower ones, each ``bucket_seconds`` halved some times."""
    width = int(bucket_seconds) * 1_000_000
    most = min(MAX_HALVINGS, (width & -width).bit_length() - 1)
    flagged = _flag_hot(df, key, plain_below, max_hot_keys, time_bucket(ts, bucket_seconds), most)
    if flagged is None:
        return None
    micros = ntz_micros(ts)
    start = micros - F.pmod(micros, F.expr(f"shiftright({width}L, {HALVINGS})"))
    return flagged.withColumn(BUCKET, F.when(F.col(HOT), start)).drop(HALVINGS)


def previous_in_order(df: DataFrame, key: Sequence[str], order: Sequence[str], carry: Sequence[str], out: str = "prev",
                      plain_below: int | None = None, max_hot_keys: int = 100_000, parts: int | None = None) -> DataFrame:
    """Add struct ``out`` holding the ``carry`` columns of the previous row of
    the same key, in ascending ``order`` (null for each key's first row).

    ``order`` should be unique per key. Rows are cut into blocks by range of (key,
    order), each a partition of a sort (``parts`` of them, else as many as Spark
    makes), so a key with any share of the rows, on one day or many, is spread.

    With ``plain_below`` set, only keys with more rows than that are cut into
    blocks; a key under it is one window, of at most ``plain_below`` rows, and
    needs no carry rows. Either way gives the same rows.
    """
    key, order, carry = list(key), list(order), list(carry)
    d = _flag_hot(df, key, plain_below, max_hot_keys)
    if d is None:
        return _previous_plain(df, key, order, carry, out)
    d = d.drop(HALVINGS)
    cut = sorted_blocks(d.where(HOT), key, order, parts).withColumnRenamed(BLOCK, BUCKET)
    if plain_below is not None:
        cut = cut.unionByName(d.where(F.col(HOT).isNull()).withColumn(BUCKET, F.lit(None).cast("int")))
    return _previous_bucketed(cut, key, order, carry, out)


def _previous_plain(df: DataFrame, key: list, order: list, carry: list, out: str) -> DataFrame:
    w = Window.partitionBy(*key).orderBy(*[F.col(c) for c in order])
    return df.withColumn(out, F.lag(F.struct(*[F.col(c) for c in carry])).over(w))


def _previous_bucketed(d: DataFrame, key: list, order: list, carry: list, out: str) -> DataFrame:
    tail_fields = order + [c for c in carry if c not in order]

    # Block level: the last row of each hot (key, block), moved to the key's next block.
    tails = d.where(HOT).groupBy(*key, BUCKET).agg(F.max(F.struct(*tail_fields)).alias("_tail"))
    carries = (
        tails.withColumn("_prev_tail", F.lag("_tail").over(Window.partitionBy(*key).orderBy(BUCKET)))
        .where(F.col("_prev_tail").isNotNull())
        .select(*key, BUCKET, F.lit(0).alias(KIND),
                F.struct(*[F.col(f"_prev_tail.{c}").alias(c) for c in carry]).alias("_carry"))
    )

    # Row level: one window per (key, bucket); the carry row sorts first.
    rows = d.withColumn(KIND, F.lit(1)).withColumn("_carry", F.struct(*[F.col(c) for c in carry]))
    w = Window.partitionBy(*key, BUCKET).orderBy(F.col(KIND), *[F.col(c) for c in order])
    return (
        rows.unionByName(carries, allowMissingColumns=True)
        .withColumn(out, F.lag("_carry").over(w))
        .where(F.col(KIND) == 1)
        .drop(KIND, "_carry", BUCKET, HOT)
    )


def running_total_and_trailing_count(df: DataFrame, key: Sequence[str], ts: str, tiebreak: str,
                                     value: str, days: int, total_out: str = "running_value",
                                     count_out: str = "trailing_entries",
                                     bucket_seconds: int = 86_400, plain_below: int | None = None,
                                     max_hot_keys: int = 100_000) -> DataFrame:
    """Per row of each key:

    * ``total_out``: exact running sum of ``value`` in (``ts``, ``tiebreak``)
      order, nulls first, this row included (``ROWS UNBOUNDED PRECEDING``),
      summed in whole cents and reported as double;
    * ``count_out``: rows of the key with ``ts`` in [ts - ``days`` days, ts],
      ties on ``ts`` included (``RANGE INTERVAL n DAYS PRECEDING``); for a row
      without ``ts``, the key's rows without one.

    Windows are partitioned by (key, bucket of ``ts``), ``bucket_seconds``
    wide or, for a key with more than ``plain_below`` rows in one, that width
    halved until they spread over enough; the width must divide the window (n
    days) into k whole buckets. A key's rows without a time go into these windows as
    one row with their sum; they themselves are summed in blocks cut by range of
    ``tiebreak``. With
    ``plain_below`` set, a key of at most that many rows is one bucket. Each
    row is also sent, shifted by n days, as a narrow *shadow row*: into bucket
    b+k of a hot key, into the one bucket of another. A sum up to each row costs
    the same for every row, so no frame is gone through again per row. The
    trailing count of an entry at time t in bucket b is

    * rows of the bucket with ts <= t,
    * less shadows in the bucket strictly before t (rows older than t - n days),
    * and for a hot key, plus all shadows of the bucket (with the term before:
      rows of bucket b-k not older than t - n days), plus all rows of buckets
      b-(k-1) .. b-1 (a frame over the bucket summary).
    """
    key = list(key)
    window_seconds = int(days) * 86_400
    if bucket_seconds <= 0 or window_seconds % bucket_seconds:
        raise ValueError("bucket_seconds must divide the trailing window")
    window = window_seconds * 1_000_000
    timed, untimed = df.where(F.col(ts).isNotNull()), df.where(F.col(ts).isNull())
    any_untimed = bool(untimed.limit(1).count())
    flagged = flag_hot_in_time(timed, key, ts, bucket_seconds, plain_below, max_hot_keys)
    any_hot = flagged is not None
    d = flagged if any_hot else timed.withColumns({HOT: F.lit(None).cast("boolean"), BUCKET: F.lit(None).cast("long")})
    d = d.withColumn("_v", cents(value)).withColumn("_tm", ntz_micros(ts))

    # Each entry and its shadow come out of one scan: a row is emitted twice
    # (kind 1 as itself, kind 2 shifted); the shadow keeps only the key, bucket
    # and shifted time.
    real = F.col(KIND) == 1
    u = (d.withColumn(KIND, F.explode(F.array(F.lit(1), F.lit(2))))
         .select(*key, HOT, F.when(real, F.col(BUCKET)).otherwise(F.col(BUCKET) + window).alias(BUCKET), KIND,
                 F.when(real, F.col(ts)).alias(ts), F.when(real, F.col(tiebreak)).alias(tiebreak),
                 F.when(real, F.col("_v")).alias("_v"),
                 F.when(real, F.col("_tm")).otherwise(F.col("_tm") + window).alias("_tm"),
                 *[F.when(real, F.col(c)).alias(c) for c in df.columns if c not in (*key, ts, tiebreak)]))
    recent = F.lit(0)
    before_time = None
    if any_untimed:  # what a key's rows without a time come to, before all others
        before_time = untimed.groupBy(*key).agg(F.sum(cents(value)).alias("_v")).withColumn(BUCKET, F.lit(None).cast("long"))
        u = u.unionByName(before_time.withColumn(KIND, F.lit(0)), allowMissingColumns=True)
    if any_hot:
        summary = d.where(HOT).groupBy(*key, BUCKET).agg(
            F.sum("_v").alias("_bucket_sum"), F.count(F.lit(1)).alias("_bucket_n"))
        if any_untimed:
            summary = summary.unionByName(before_time.withColumnRenamed("_v", "_bucket_sum"), allowMissingColumns=True)
        per_key = Window.partitionBy(*key).orderBy(BUCKET)
        carries = summary.select(
            *key, BUCKET, F.lit(0).alias(KIND),
            F.sum("_bucket_sum").over(per_key.rowsBetween(_UNBOUNDED_PRECEDING, -1)).alias("_v"),
            F.sum("_bucket_n").over(per_key.rangeBetween(-(window - 1), -1)).alias("_recent"),
        ).where(F.col(BUCKET).isNotNull())
        u = u.unionByName(carries, allowMissingColumns=True)
        recent = F.coalesce(F.max("_recent").over(Window.partitionBy(*key, BUCKET)), F.lit(0))

    # One sort serves every window: rows run by (_tm, kind, tiebreak). Carry
    # rows have no _tm and come first; a shadow row adds nothing to the running
    # sum; the range frames order by _tm alone, a prefix of the same sort.
    part = Window.partitionBy(*key, BUCKET)
    in_order = part.orderBy(F.col("_tm"), F.col(KIND), F.col(tiebreak)).rowsBetween(_UNBOUNDED_PRECEDING, _CURRENT)
    by_time = part.orderBy(F.col("_tm"))
    upto, before = by_time.rangeBetween(_UNBOUNDED_PRECEDING, _CURRENT), by_time.rangeBetween(_UNBOUNDED_PRECEDING, -1)
    is_shadow = (F.col(KIND) == 2).cast("int")
    timed_upto = F.sum(real.cast("int")).over(upto)
    shadows_before = F.coalesce(F.sum(is_shadow).over(before), F.lit(0))
    carried = F.when(F.col(HOT), F.sum(is_shadow).over(part) + recent).otherwise(0)
    out = (
        u.withColumn(total_out, F.sum("_v").over(in_order) / 100)
        .withColumn(count_out, (timed_upto - shadows_before + carried).cast("long"))
        .where(F.col(KIND) == 1)
        .drop(KIND, "_v", "_tm", "_recent", BUCKET, HOT)
    )
    if not any_untimed:
        return out
    many = untimed.groupBy(*key).agg(F.count(F.lit(1)).alias("_many")).select(*[F.col(k).alias(f"_key_{i}") for i, k in enumerate(key)], "_many")
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_key_{i}")) for i, k in enumerate(key)])
    summed = running_sums(untimed.withColumns({"_v": cents(value), "_some": cents(value).isNotNull().cast("long")}), key, [tiebreak],
                          {"_sum": "_v", "_n": "_some"})
    first = summed.join(many, same).select(
        *df.columns, F.when(F.col("_n") > 0, F.col("_sum") / 100).alias(total_out), F.col("_many").alias(count_out))
    return out.select(*first.columns).unionByName(first)


def episodes(df: DataFrame, key: Sequence[str], ts: str, gap_seconds: int,
             bucket_seconds: int = 86_400, plain_below: int | None = None,
             max_hot_keys: int = 100_000) -> DataFrame:
    """Runs of a key's rows in which no two consecutive rows are more than
    ``gap_seconds`` apart (a gap of exactly ``gap_seconds`` joins the run).

    Rows without ``ts`` are in no run. Returns one row per run: ``key``, ``episode_start`` (first ``ts``),
    ``episode_end`` (last ``ts`` + gap, as ``session_window`` reports it) and
    ``entries``.

    Level 1 finds the runs inside each (key, bucket) with ``lag`` and a
    running count of breaks, and aggregates them in place (the aggregate
    reuses the window's partitioning). Level 2 merges runs that continue
    across a bucket boundary; it sees one row per run per bucket, at most
    about bucket / gap + 1 rows per person-bucket.

    With ``plain_below`` set, only keys with more rows than that take the two
    levels; the rest take one plain per-key window.
    """
    key = list(key)
    gap = _interval_seconds(gap_seconds)
    d = df.select(*key, ts).where(F.col(ts).isNotNull())
    flagged = flag_hot_in_time(d, key, ts, bucket_seconds, plain_below, max_hot_keys)
    if flagged is None:
        return _episodes_plain(d, key, ts, gap)
    hot = _episodes_bucketed(flagged.where(HOT).drop(HOT), key, ts, gap)
    if plain_below is None:
        return hot
    return _episodes_plain(flagged.where(F.col(HOT).isNull()).drop(HOT, BUCKET), key, ts, gap).unionByName(hot)


def _episodes_plain(d: DataFrame, key: list, ts: str, gap: Column) -> DataFrame:
    w = Window.partitionBy(*key).orderBy(ts)
    return (
        d.withColumn("_prev", F.lag(ts).over(w))
        .withColumn("_break", F.when(F.col("_prev").isNull() | (F.col(ts) > F.col("_prev") + gap), 1)
                    .otherwise(0))
        .withColumn("_episode", F.sum("_break").over(w.rowsBetween(_UNBOUNDED_PRECEDING, _CURRENT)))
        .groupBy(*key, "_episode")
        .agg(F.min(ts).alias("episode_start"), (F.max(ts) + gap).alias("episode_end"),
             F.count(F.lit(1)).cast("long").alias("entries"))
        .drop("_episode")
    )


def _episodes_bucketed(d: DataFrame, key: list, ts: str, gap: Column) -> DataFrame:
    w = Window.partitionBy(*key, BUCKET).orderBy(ts)
    local = (
        d.withColumn("_prev", F.lag(ts).over(w))
        .withColumn("_break", F.when(F.col("_prev").isNull() | (F.col(ts) > F.col("_prev") + gap), 1)
                    .otherwise(0))
        .withColumn("_run", F.sum("_break").over(w.rowsBetween(_UNBOUNDED_PRECEDING, _CURRENT)))
        .groupBy(*key, BUCKET, "_run")
        .agg(F.min(ts).alias("_first"), F.max(ts).alias("_last"), F.count(F.lit(1)).alias("_n"))
    )
    w2 = Window.partitionBy(*key).orderBy("_first")
    return (
        local.withColumn("_prev", F.lag("_last").over(w2))
        .withColumn("_break", F.when(F.col("_prev").isNull() | (F.col("_first") > F.col("_prev") + gap), 1)
                    .otherwise(0))
        .withColumn("_episode", F.sum("_break").over(w2.rowsBetween(_UNBOUNDED_PRECEDING, _CURRENT)))
        .groupBy(*key, "_episode")
        .agg(F.min("_first").alias("episode_start"),
             (F.max("_last") + gap).alias("episode_end"),
             F.sum("_n").cast("long").alias("entries"))
        .drop("_episode")
    )
