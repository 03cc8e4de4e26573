"""Diary entries as a stream of files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from carebook.functions.columns import ntz_to_instant
from carebook.sources.schemas import EVENTS
from carebook.sources.tables import table_path

EVENT_TIME = "event_time"


def read_entries_stream(spark: SparkSession, folder: str, glob: str | None = "events.parquet",
                        max_files_per_trigger: int | None = None,
                        max_bytes_per_trigger: int | None = None) -> DataFrame:
    """Entries arriving as parquet files in ``folder`` (fixed schema).

    ``max_files_per_trigger`` or ``max_bytes_per_trigger`` (one of them, as
    Spark requires) bounds each micro-batch, and with it what any one key can
    put into one task per batch.
    Adds ``event_time``: ``ts`` as a TIMESTAMP (watermarks need one), read as
    UTC wall clock whatever the session time zone.
    """
    reader = spark.readStream.schema(EVENTS).format("parquet")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if max_files_per_trigger and max_bytes_per_trigger:
        raise ValueError("set max_files_per_trigger or max_bytes_per_trigger, not both")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    if max_bytes_per_trigger:
        reader = reader.option("maxBytesPerTrigger", str(int(max_bytes_per_trigger)))
    return reader.load(folder).withColumn(EVENT_TIME, ntz_to_instant("ts"))


def _is_directory(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.getFileStatus(hpath).isDirectory()


def read_entries_table_stream(spark: SparkSession, base_dir: str, **limits) -> DataFrame:
    """The ``events`` table under ``base_dir`` as a stream.

    ``events.parquet`` may be a folder of part files (new files arriving in
    it) or a single file; a file stream source needs a folder, so a single
    file is read from its parent folder with a file-name filter.
    """
    path = table_path(base_dir, "events")
    if _is_directory(spark, path):
        return read_entries_stream(spark, path, glob=None, **limits)
    return read_entries_stream(spark, base_dir, glob="events.parquet", **limits)
