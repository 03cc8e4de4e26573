"""Token ids in Parquet: written in document order, read selectively.

Layout of a file (one per range of doc_ids): ``tokens`` is a list column with
dictionary encoding (a vocabulary's dictionary fits one page, so ids are stored
in as many bits as they need); ``doc_id``, ``local_start`` and ``n_tokens``
rise or vary little and use delta encoding; row groups and pages have set
sizes, and the writer adds column and offset indexes. A read of some columns
touches only their chunks, and a read of a doc_id range only the pages whose
index overlaps it.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from carebook.llm.common import on_workers, text_key
from carebook.llm.tokenizing import encoder, list_parts, slices, with_end_id
from carebook.operators.broadcast import bounded_broadcast

FILE_SCHEMA = "doc_id long, shard int, local_start long, n_tokens long, tokens array<int>"
_ARROW = pa.schema([("doc_id", pa.int64()), ("shard", pa.int32()), ("local_start", pa.int64()),
                    ("n_tokens", pa.int64()), ("tokens", pa.list_(pa.int32()))])
_DELTA_COLUMNS = ("doc_id", "shard", "local_start", "n_tokens")
MAX_SHARDS = 1_000_000


def _encode_batches(batches: Iterator[pa.RecordBatch], path: str, end_id: int) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext
    encode, shard, done = encoder(path).encode, TaskContext.get().partitionId(), 0
    for batch in batches:
        for part in slices(batch, "text"):
            tokens = with_end_id(encode(part.column("text")), end_id)
            n = np.diff(list_parts(tokens)[0])
            start = done + np.cumsum(n) - n
            done += int(n.sum())
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(np.full(len(n), shard, np.int32)), pa.array(start), pa.array(n), tokens],
                schema=_ARROW)


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int = 2,
                 row_group_bytes: int = 32 << 20, page_bytes: int = 256 << 10, page_rows: int = 2_000) -> None:
    """Encode every text, add ``end_id`` and write the ids in ascending doc_id order.

    ``docs`` has ``doc_id`` and ``text``; other columns are not read. Documents
    are range-partitioned and sorted by (doc_id, hash of the text, row), so file
    order is document order, null doc_ids come first, and rows that repeat one
    doc_id, or a doc_id and its text, still spread over files. A null text is the empty text: its ids are
    the end id alone. An empty table gives a folder without rows.

    One shuffle, of the texts. Ids go from the encoder straight to the file; a
    task that is run again writes its own file anew.
    """
    key = [F.col("doc_id").asc_nulls_first(), F.col("_text_key"), F.col("_row")]
    ordered = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                           F.monotonically_increasing_id().alias("_row"))
               .withColumn("_text_key", text_key(F.col("text")))
               .repartitionByRange(*key).sortWithinPartitions(*key).drop("_text_key", "_row"))
    writer = (ordered.mapInArrow(on_workers(__name__, "_encode_batches", tokenizer, end_id), FILE_SCHEMA).write
              .option("compression", "zstd").option("parquet.writer.version", "PARQUET_2_0")
              .option("parquet.block.size", row_group_bytes).option("parquet.page.size", page_bytes)
              .option("parquet.page.row.count.limit", page_rows).option("parquet.enable.dictionary", "true"))
    for column in _DELTA_COLUMNS:
        writer = writer.option(f"parquet.enable.dictionary#{column}", "false")
    writer.parquet(path)


def read_tokens(spark: SparkSession, path: str, columns: list[str] | None = None,
                first: int | None = None, last: int | None = None) -> DataFrame:
    """The written rows; ``columns`` and a doc_id range [first, last] reach the scan.

    Without ``tokens`` among the columns no ids are read. ``start`` (ids of all
    documents before the row's) may be asked for besides the file's columns: it
    is ``local_start`` plus the ids in the files before, of which there is one
    number per file.
    """
    files = spark.read.schema(FILE_SCHEMA).parquet(path)
    wanted = columns or ["doc_id", "start", "n_tokens", "tokens"]
    rows = files
    if first is not None:
        rows = rows.where(F.col("doc_id") >= first)
    if last is not None:
        rows = rows.where(F.col("doc_id") <= last)
    if "start" in wanted:
        per_file = files.groupBy("shard").agg(F.sum("n_tokens").alias("_n"))
        before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
        bases = per_file.select("shard", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
        rows = rows.join(bounded_broadcast(bases, MAX_SHARDS), "shard").withColumn("start", F.col("local_start") + F.col("_base"))
    return rows.select(*wanted)


def _digest_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        offsets, ids = list_parts(batch.column("tokens"))
        raw = memoryview(ids.astype("<u4").tobytes())
        crc = [zlib.crc32(raw[4 * a:4 * b]) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("start"), batch.column("n_tokens"), pa.array(crc, pa.int64())],
            names=["doc_id", "start", "n_tokens", "ids_crc32"])


def token_digests(rows: DataFrame) -> DataFrame:
    """``doc_id``, ``start``, ``n_tokens`` and the unsigned CRC-32 of each row's ids."""
    return rows.select("doc_id", "start", "n_tokens", "tokens").mapInArrow(
        on_workers(__name__, "_digest_batches"), "doc_id long, start long, n_tokens long, ids_crc32 long")
