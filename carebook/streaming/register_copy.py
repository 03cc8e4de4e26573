"""The register, kept bucketed by person between micro-batches."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carebook.plans.register import register
from carebook.session import fresh_dir
from carebook.sources.tables import Tables, table_path

REGISTER_TABLES = ("customer", "nation", "region")


def file_state(spark: SparkSession, path: str) -> list[tuple[str, int, int]]:
    """(path, length, modification time) of the files at ``path``, a file or a folder of them."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files, out = fs.listFiles(root, True), []
    while files.hasNext():
        f = files.next()
        out.append((f.getPath().toString(), f.getLen(), f.getModificationTime()))
    return sorted(out)


class RegisterCopy:
    """A bucketed copy of the register under the shared folder, made anew when the register's files change.

    Written in ``buckets`` buckets by person, each sorted, so that a join on the
    person reads it without a shuffle. ``current`` compares the files' names,
    lengths and times (a listing, no job) and gives the copy of what is there now. A
    copy that a later one replaces keeps its files, as a running batch may read them.
    """

    def __init__(self, spark: SparkSession, base_dir: str, buckets: int | None = None):
        self._spark, self._base_dir = spark, base_dir
        self._buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self._state: list | None = None
        self._table = ""

    def current(self) -> DataFrame:
        """Persons with district and area (``plans.register.register``), bucketed by ``c_custkey``."""
        state = [f for t in REGISTER_TABLES for f in file_state(self._spark, table_path(self._base_dir, t))]
        if state != self._state:
            old, self._table = self._table, f"carebook_register_{uuid.uuid4().hex}"
            (register(Tables(self._spark, self._base_dir)).write.bucketBy(self._buckets, "c_custkey").sortBy("c_custkey")
             .option("path", fresh_dir(self._spark, "register-copy")).saveAsTable(self._table))
            self._state = state
            if old:
                self._spark.sql(f"DROP TABLE IF EXISTS {old}")
        return self._spark.table(self._table)

    def persons_of(self, entries: DataFrame) -> DataFrame:
        """The register's rows of the persons in ``entries``.

        Only distinct persons are shuffled, to the copy's buckets; the copy is read
        where it lies. What comes out is as large as the batch has persons, so
        joining entries to it can be split where one person has many.
        """
        here = entries.where(F.col("user_id").isNotNull()).select(F.col("user_id").alias("_person")).distinct()
        if self._buckets != int(self._spark.conf.get("spark.sql.shuffle.partitions")):
            here = here.repartition(self._buckets, "_person")
        return self.current().join(here, F.col("c_custkey") == F.col("_person"), "left_semi")
