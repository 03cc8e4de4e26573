"""Parquet sink for streams: long-running, or drained once with ``availableNow``."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import BooleanType, LongType, StructField, StructType

from carebook.session import fresh_dir


def start_to_parquet(stream: DataFrame, out_dir: str, checkpoint_dir: str,
                     processing_time: str | None = None, available_now: bool = False,
                     query_name: str | None = None) -> StreamingQuery:
    """Start appending ``stream`` to parquet files in ``out_dir``.

    The file sink with a checkpoint is exactly-once: a restarted query (after
    a lost driver or executor) resumes from the checkpoint's offsets and state,
    and readers of ``out_dir`` see only committed files (``_spark_metadata``).
    ``processing_time`` (e.g. ``"1 minute"``) starts a micro-batch on that
    interval; ``available_now`` processes what is there and stops.
    """
    w = (stream.writeStream.format("parquet").outputMode("append")
         .option("path", out_dir).option("checkpointLocation", checkpoint_dir)
         .queryName(query_name or f"carebook_{uuid.uuid4().hex}"))
    if available_now:
        w = w.trigger(availableNow=True)
    elif processing_time:
        w = w.trigger(processingTime=processing_time)
    return w.start()


def drain_to_parquet(stream: DataFrame, out_dir: str, checkpoint_dir: str,
                     query_name: str | None = None) -> None:
    """Process everything available now into ``out_dir`` and stop."""
    finish(start_to_parquet(stream, out_dir, checkpoint_dir, available_now=True, query_name=query_name))


def finish(q: StreamingQuery) -> None:
    """Wait for a draining query; raise if it failed."""
    q.awaitTermination()
    err = q.exception()
    if err is not None:
        raise RuntimeError(f"stream {q.name} failed: {err}")


def drain_and_read(spark: SparkSession, stream: DataFrame, purpose: str, out_dir: str | None = None,
                   checkpoint_dir: str | None = None) -> DataFrame:
    """Drain ``stream`` and return the committed output as a batch DataFrame.

    Without folders it goes into fresh ones under the shared checkpoint root. A caller
    who gives both can drain again later: only what has arrived since is read,
    and the output holds the rows of all drains. The two belong together, so
    one without the other is an error.
    """
    if (out_dir is None) != (checkpoint_dir is None):
        raise ValueError("give out_dir and checkpoint_dir, or neither")
    out_dir = out_dir or fresh_dir(spark, f"{purpose}-out")
    drain_to_parquet(stream, out_dir, checkpoint_dir or fresh_dir(spark, f"{purpose}-checkpoint"))
    return spark.read.schema(stream.schema).parquet(out_dir)


def start_batches(spark: SparkSession, stream: DataFrame, transform: Callable[[DataFrame], DataFrame], flag: str,
                  out_dir: str, checkpoint_dir: str, processing_time: str | None = None,
                  available_now: bool = False, query_name: str | None = None) -> StreamingQuery:
    """Start writing ``transform(micro-batch)`` to ``out_dir/batch=N/<flag>=...``.

    ``transform`` runs anew for each micro-batch, so what it reads besides the
    batch is as of then. A batch that is run again overwrites its own folder:
    each batch's rows are there once. Read with ``read_batches``.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        transform(batch).write.mode("overwrite").partitionBy(flag).parquet(f"{out_dir}/batch={batch_id}")

    # The folder exists even if no batch comes; without rows no partition and no file is written.
    spark.range(0).select("id", F.col("id").alias("batch")).write.mode("ignore").partitionBy("batch").parquet(out_dir)
    w = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint_dir).queryName(
        query_name or f"carebook_{uuid.uuid4().hex}")
    if available_now:
        w = w.trigger(availableNow=True)
    elif processing_time:
        w = w.trigger(processingTime=processing_time)
    return w.start()


def read_batches(spark: SparkSession, out_dir: str, schema: StructType, flag: str, value: bool) -> DataFrame:
    """The rows of ``start_batches``' output whose ``flag`` has ``value`` (one folder each), without the flag."""
    fields = [f for f in schema.fields if f.name != flag]
    layout = StructType([*fields, StructField("batch", LongType()), StructField(flag, BooleanType())])
    rows = spark.read.schema(layout).option("basePath", out_dir).parquet(out_dir)
    return rows.where(F.col(flag) == value).select(*[f.name for f in fields])
