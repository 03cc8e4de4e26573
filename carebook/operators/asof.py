"""As-of join: each row with the other side's last row before it."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from carebook.functions.columns import ntz_micros
from carebook.operators.ordered import BUCKET, HOT, flag_hot_in_time

_KIND, _SIDE, _TM, _TIE = "_kind", "_side", "_tm", "_tie"


def as_of_join(left: DataFrame, right: DataFrame, key: Sequence[str], ts: str, tiebreak: str, carry: Sequence[str],
               out: str, strict: bool = True, bucket_seconds: int = 86_400, plain_below: int | None = None,
               max_hot_keys: int = 100_000) -> DataFrame:
    """``left`` with struct ``out``: the ``carry`` columns of the same key's ``right`` row with the
    latest ``ts`` before the left row's (``strict``; else not after it), null if there is none.

    Both sides have the ``key`` columns and the TIMESTAMP_NTZ ``ts``. Of right rows
    with one time the highest ``tiebreak`` counts. Right rows without a key or a
    time are no match for any row, and left rows without one have none: they go past
    the join, so many of them are no hot key. Each left row comes out once.

    The sides are put in one sequence per key (a union, not a join, so no pair of
    rows is ever made) and the last right row is carried along it. Keys with more
    than ``plain_below`` rows on both sides together are cut into time buckets
    (``operators.ordered``), and each bucket starts with a carry row: the last right
    row of the buckets before.
    """
    key, cols = list(key), left.columns
    whole = reduce(and_, [F.col(c).isNotNull() for c in (*key, ts)])
    keys = [F.col(k) for k in key]
    payload = F.struct(*[F.col(c) for c in cols])
    found = F.struct(*[F.col(c) for c in carry])
    lefts = left.where(whole).select(*keys, F.col(ts).alias("_ts"), F.lit(0 if strict else 2).alias(_SIDE), payload.alias("_left"))
    rights = right.where(whole).select(*keys, F.col(ts).alias("_ts"), F.lit(1).alias(_SIDE), F.col(tiebreak).alias(_TIE), found.alias("_right"))
    both = lefts.unionByName(rights, allowMissingColumns=True)

    flagged = flag_hot_in_time(both, key, "_ts", bucket_seconds, plain_below, max_hot_keys)
    u = (both if flagged is None else flagged).withColumns({_TM: ntz_micros("_ts"), _KIND: F.lit(1)}).drop("_ts")
    part = key
    if flagged is not None:
        part = [*key, BUCKET]
        tail = F.when(F.col(_SIDE) == 1, F.struct(_TM, _TIE, "_right"))
        earlier = Window.partitionBy(*key).orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)
        carries = (u.where(HOT).groupBy(*part).agg(F.max(tail).alias("_tail"))
                   .withColumn("_tail", F.max("_tail").over(earlier)).where(F.col("_tail").isNotNull())
                   .select(*part, F.lit(0).alias(_KIND), F.col("_tail._right").alias("_right")))
        u = u.drop(HOT).unionByName(carries, allowMissingColumns=True)
    upto = Window.partitionBy(*part).orderBy(_KIND, _TM, _SIDE, _TIE).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    joined = (u.withColumn(out, F.last("_right", ignorenulls=True).over(upto)).where(F.col("_left").isNotNull())
              .select(*[F.col("_left").getField(c).alias(c) for c in cols], out))
    return joined.unionByName(left.where(~whole).withColumn(out, F.lit(None).cast(joined.schema[out].dataType)))
