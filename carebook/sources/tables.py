"""Batch readers for the diary and register tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from carebook.sources.schemas import SCHEMAS


def table_path(base_dir: str, name: str) -> str:
    return f"{base_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, base_dir: str, name: str) -> DataFrame:
    """Read one table with its fixed schema (vectorized parquet scan).

    Projection and filters written later on the DataFrame reach the scan as
    ``ReadSchema`` / ``PushedFilters``.
    """
    return spark.read.schema(SCHEMAS[name]).parquet(table_path(base_dir, name))


class Tables:
    """Lazy accessors: ``Tables(spark, sf_dir).events`` etc."""

    def __init__(self, spark: SparkSession, base_dir: str):
        self.spark = spark
        self.base_dir = base_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name in SCHEMAS:
            return read_table(self.spark, self.base_dir, name)
        raise AttributeError(name)
