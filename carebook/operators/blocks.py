"""Prefix sums over range partitions.

A group (a district, a person) may hold a third of all rows, so its rows are never
one window. Rows are cut by range of (group, order) into blocks, each a
partition; sums run inside (group, block), and the totals of a group's earlier
blocks, at most one row per block edge, are carried in.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from carebook.operators.broadcast import bounded_broadcast
from carebook.session import fresh_dir

BLOCK = "_block"
MAX_CARRIED = 100_000


def sorted_blocks(df: DataFrame, group: Sequence[str], order: Sequence[str], parts: int | None = None) -> DataFrame:
    """``df`` with BLOCK, which never decreases along (group, order).

    Rows that agree in all of these lie in one block. Written once to the shared
    folder, so that every later use, or a lost executor's tasks, see the same cuts.
    """
    cols = [*group, *order]
    ranged = df.repartitionByRange(parts, *cols) if parts else df.repartitionByRange(*cols)
    cut = ranged.withColumn(BLOCK, F.spark_partition_id())
    path = fresh_dir(df.sparkSession, "blocks")
    cut.write.parquet(path)
    return df.sparkSession.read.schema(cut.schema).parquet(path)


def running_sums(df: DataFrame, group: Sequence[str], order: Sequence[str], values: dict[str, str],
                 parts: int | None = None) -> DataFrame:
    """``df`` with, for each ``out: value``, the exact sum of the long column ``value`` over the
    group's rows up to this one in ``order`` (nulls first), which should be unique per group.

    A null value adds nothing; a null group is a group. The carried totals are at
    most one row per block edge and are broadcast behind a check of that.
    """
    group = list(group)
    cut = sorted_blocks(df, group, order, parts)
    totals = cut.groupBy(*group, BLOCK).agg(*[F.coalesce(F.sum(v), F.lit(0)).alias(f"_sum_{o}") for o, v in values.items()])
    earlier = Window.partitionBy(*group).orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    carried = totals.select(*[F.col(g).alias(f"_group_{i}") for i, g in enumerate(group)], F.col(BLOCK).alias("_at_block"),
                            *[F.sum(f"_sum_{o}").over(earlier).alias(f"_carried_{o}") for o in values])
    carried = carried.where(F.col(f"_carried_{next(iter(values))}").isNotNull())
    same = reduce(and_, [F.col(g).eqNullSafe(F.col(f"_group_{i}")) for i, g in enumerate(group)], F.col(BLOCK) == F.col("_at_block"))
    inside = Window.partitionBy(*group, BLOCK).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = cut.withColumns({o: F.coalesce(F.sum(v).over(inside), F.lit(0)) for o, v in values.items()})
    out = {o: F.col(o) + F.coalesce(F.col(f"_carried_{o}"), F.lit(0)) for o in values}
    return summed.join(bounded_broadcast(carried, MAX_CARRIED), same, "left").withColumns(out).select(*df.columns, *values)
