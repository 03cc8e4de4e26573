"""Helpers shared by the operators: worker entry points, the shared folder, inputs."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carebook.operators.broadcast import bounded_broadcast
from carebook.session import fresh_dir

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def on_workers(module: str, function: str, *args) -> Callable[[Iterator], Iterator]:
    """A function for ``mapInArrow`` that imports its code inside the worker.

    Only names and ``args`` travel with the task, so state that a module keeps
    between tasks of one worker (a tokenizer, a compiled table) is reused. The
    package's folder is added to the import path for workers that were started
    from another one; where the package is installed this changes nothing.
    """
    root = ROOT

    def run(batches):
        import importlib
        import sys
        if root not in sys.path:
            sys.path.append(root)
        return getattr(importlib.import_module(module), function)(batches, *args)

    return run


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` once to the shared folder and return it read back.

    Cuts the lineage: what follows reads files, not an executor's memory, so a
    lost executor costs the tasks it ran and nothing that was already written.
    """
    spark = df.sparkSession
    path = fresh_dir(spark, f"llm-{purpose}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def has_rows(df: DataFrame) -> bool:
    return bool(df.limit(1).count())


def text_key(text) -> F.Column:
    """64-bit hash of a text (null: 42, the seed), to tell rows of one id apart."""
    return F.xxhash64(text)


def quoted(name: str) -> F.Column:
    """The column of this very name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def keyed(docs: DataFrame) -> DataFrame:
    """``row`` (all columns of ``docs``), ``key_id`` and ``key_text``: a row's doc_id and
    the hash of its text. Apart from these, no name of the input's is left to clash."""
    return docs.select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("key_id"),
                       text_key(F.col("text").cast("string")).alias("key_text"))


def rows_without(docs: DataFrame, gone: DataFrame, max_listed: int = 200_000) -> DataFrame:
    """The rows of ``docs`` whose (doc_id, text_key) is not among ``gone``'s, with their own columns.

    ``gone`` is broadcast only while it has at most ``max_listed`` rows.
    """
    listed = gone.select(F.col("doc_id").alias("gone_id"), F.col("text_key").alias("gone_text")).distinct()
    same = F.col("key_id").eqNullSafe(F.col("gone_id")) & (F.col("key_text") == F.col("gone_text"))
    return keyed(docs).join(bounded_broadcast(stored(listed, "gone"), max_listed), same, "left_anti").select("row.*")
