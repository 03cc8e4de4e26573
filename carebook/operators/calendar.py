"""Days on which a key has no row, without a key x calendar cross join."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def missing_days(days: DataFrame, key: Sequence[str], day: str, start: dt.date, end: dt.date,
                 out: str = "day") -> DataFrame:
    """For every key present in ``days`` (key, day), each date in [start, end]
    on which the key has no row.

    One aggregate gathers each key's distinct dates within the period, at most
    as many as the period has, in every map task before the shuffle; the dates
    missing from the period's sequence are then expanded. One scan, one shuffle,
    and work in proportion to the distinct days and the output.
    """
    key = list(key)
    in_period = F.when(F.col(day).between(F.lit(start), F.lit(end)), F.col(day))
    seen = days.groupBy(*key).agg(F.collect_set(in_period).alias("_seen"))
    period = F.sequence(F.lit(start), F.lit(end))
    return seen.select(*key, F.explode(F.array_except(period, "_seen")).alias(out))
