"""Aggregate state kept per day, extended day by day and merged for any period."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

DAY = "day"


def between(days: DataFrame, start: dt.date | None, end: dt.date | None, day: str = DAY) -> DataFrame:
    """Rows whose ``day`` lies in [start, end); an open end has no limit. Rows without a day are left out."""
    kept = days.where(F.col(day).isNotNull())
    kept = kept if start is None else kept.where(F.col(day) >= F.lit(start))
    return kept if end is None else kept.where(F.col(day) < F.lit(end))


def extend(state: DataFrame, store: str) -> None:
    """Write ``state`` (one row per ``day`` and group) into ``store``, a folder per day.

    Days that ``state`` holds replace what the store has of them, so a period that
    is computed again, after a failure or for late entries, is there once; other
    days stay. A lost executor repeats its tasks; a failed write leaves the old days.
    """
    state.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(DAY).parquet(store)


def read(spark: SparkSession, store: str, schema: StructType, start: dt.date | None = None, end: dt.date | None = None) -> DataFrame:
    """The stored rows of a period; only that period's folders are read."""
    return between(spark.read.schema(schema).parquet(store), start, end)
