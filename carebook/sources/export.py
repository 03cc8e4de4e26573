"""Day-partitioned parquet export of diary entries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from carebook.sources.schemas import EVENTS

EXPORT_SCHEMA = T.StructType(list(EVENTS.fields) + [T.StructField("day", T.DateType())])


def write_by_day(entries: DataFrame, path: str) -> None:
    """Write entries as ``path/day=YYYY-MM-DD/*.parquet``.

    Rows are rebalanced by day first: a day's entries meet in as many tasks as
    their size asks for, however the input is ordered, so there are about
    (day's size / target size) files a day and a busy day is split, never
    funnelled into one task. ``errorifexists`` keeps a rerun from mixing two exports; callers pass a
    fresh path.
    """
    (entries.withColumn("day", F.to_date("ts")).hint("rebalance", "day")
     .write.mode("errorifexists").partitionBy("day").parquet(path))


def read_by_day(spark: SparkSession, path: str) -> DataFrame:
    """Read an export back; filters on ``day`` prune whole directories."""
    return spark.read.schema(EXPORT_SCHEMA).parquet(path)
