"""Latest row and top-k rows per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, key: Sequence[str], order: Sequence[str],
                   cols: Sequence[str]) -> DataFrame:
    """The last row of each key by ``order`` (ascending; later columns break ties).

    Written as ``max(struct(order..., cols...))``: a partial aggregate keeps
    one candidate per key in every map task before the shuffle, so a key
    holding a third of all rows ships one row per task. Struct buffers are
    aggregated sort-based (Spark sorts each map task's rows by the key only,
    not by the full order as ``row_number()`` would). ``order`` must make rows
    unique per key for the result to be deterministic.
    """
    key, order = list(key), list(order)
    rest = [c for c in cols if c not in key and c not in order]
    best = F.max(F.struct(*[F.col(c) for c in order + rest])).alias("_best")
    return df.groupBy(*key).agg(best).select(*key, *[F.col(f"_best.{c}").alias(c) for c in order + rest])


def top_k_per_group(df: DataFrame, group: Sequence[str], k: int, order: Sequence[Column],
                    rank_col: str = "rank") -> DataFrame:
    """The first ``k`` rows of each group by ``order``, numbered 1..k.

    ``row_number() <= k`` is planned with ``WindowGroupLimit`` both before and
    after the shuffle, so each map task forwards at most ``k`` rows per group;
    a group with a third of all rows does not reach one task whole.
    """
    w = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn(rank_col, F.row_number().over(w)).where(F.col(rank_col) <= k)
