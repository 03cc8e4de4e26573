"""Export of the diary by day."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from carebook.session import fresh_dir
from carebook.sources.export import read_by_day, write_by_day
from carebook.sources.tables import Tables


def diary_day_export(spark: SparkSession, sf_dir: str, out_dir: str | None = None) -> DataFrame:
    """Write all entries partitioned by day and return the export read back.

    The output goes under the shared ``spark.checkpoint.dir`` unless a path is
    given. This runs the write when called; the returned DataFrame reads the
    written files.
    """
    out_dir = out_dir or fresh_dir(spark, "diary-by-day")
    write_by_day(Tables(spark, sf_dir).events, out_dir)
    return read_by_day(spark, out_dir)
