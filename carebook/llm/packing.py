"""Packing by powers of two: no sequence crosses a document, none is padded.

A document of n ids is cut into floor(n / max_length) pieces of ``max_length``
and then, for the rest, one piece for each set bit of its length, longest
first. Each piece is a sequence of its own, and sequences of equal length form
a bucket from which a training batch is drawn whole.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carebook.llm.common import on_workers
from carebook.llm.tokenizing import encoder, list_parts, slices, with_end_id
from carebook.llm.worker_memory import release

# Sequence ids: the bucket's number (log2 of its length) above this many bits,
# the piece's own number below.
BUCKET_SHIFT = 58

_PIECES = "doc_id long, start long, length long, doc_tokens long, ids_crc32 long, tokens array<int>"
_ARROW = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()),
                    ("doc_tokens", pa.int64()), ("ids_crc32", pa.int64()), ("tokens", pa.list_(pa.int32()))])


def piece_lengths(n: int, max_length: int) -> list[int]:
    """Lengths of the pieces of a document of ``n`` ids, in order."""
    bits = [1 << b for b in range(max_length.bit_length() - 1, -1, -1) if n % max_length >> b & 1]
    return [max_length] * (n // max_length) + bits


def pieces_of(lengths: np.ndarray, max_length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For documents of ``lengths`` ids: each piece's document, start and length."""
    full, rest = lengths // max_length, lengths % max_length
    bits = np.arange(max_length.bit_length() - 1, -1, -1)
    is_set = rest[:, None] >> bits & 1 == 1
    counts = full + is_set.sum(1)
    doc = np.repeat(np.arange(len(lengths)), counts)
    place = np.arange(len(doc)) - np.repeat(np.cumsum(counts) - counts, counts)
    length = np.full(len(doc), max_length, np.int64)
    length[place >= full[doc]] = np.broadcast_to(1 << bits, is_set.shape)[is_set]
    upto = np.cumsum(length)
    before = np.concatenate([[0], np.cumsum(lengths)[:-1]]) if len(lengths) else np.zeros(0, np.int64)
    return doc, upto - length - before[doc], length


def _pack_batches(batches: Iterator[pa.RecordBatch], path: str, end_id: int,
                  max_length: int) -> Iterator[pa.RecordBatch]:
    encode = encoder(path).encode
    for batch in batches:
        for part in slices(batch, "text"):
            offsets, ids = list_parts(with_end_id(encode(part.column("text")), end_id))
            n = np.diff(offsets)
            doc, start, length = pieces_of(n, max_length)
            ends = np.concatenate([[0], np.cumsum(length)])
            raw = memoryview(ids.astype("<u4").tobytes())
            crc = np.fromiter((zlib.crc32(raw[4 * a:4 * b]) for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())),
                              np.int64, len(doc))
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id").take(pa.array(doc)), pa.array(start), pa.array(length), pa.array(n[doc]),
                 pa.array(crc), pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(ids))],
                schema=_ARROW)
            release()


def pack(docs: DataFrame, tokenizer: str, end_id: int = 1, max_length: int = 2048) -> DataFrame:
    """Every document's ids, with ``end_id`` after them, as pieces whose length
    is a power of two.

    ``docs`` has ``doc_id`` and ``text``; other columns are not read, whatever
    their names. Returns one row per piece: ``doc_id``, ``start`` (ids of its
    document before it), ``length``, ``doc_tokens`` (ids of its document, the
    end id included), ``ids_crc32`` (of the piece's ids as little-endian
    unsigned 32-bit integers), ``tokens``, ``sequence_id`` and ``offset``
    (always 0: a piece fills its sequence). Sequence ids sort by length first,
    so each bucket is one range of ids. Nothing is padded.

    A null text is the empty text: one piece holding the end id. Null or
    repeated doc_ids are kept; each row is packed by itself. An empty table
    gives no rows. ``max_length`` must be a power of two.

    There is no shuffle: a piece comes from one row. Sequence ids are made from
    the task's partition and the row's place in it; write the result once
    (``write_buckets``, or any table) before using ids in a second job over an
    input whose row order is not fixed.
    """
    if max_length < 1 or max_length & (max_length - 1):
        raise ValueError("max_length must be a power of two")
    pieces = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        on_workers(__name__, "_pack_batches", tokenizer, end_id, max_length), _PIECES)
    bucket = F.log2("length").cast("long")
    return (pieces.withColumn("sequence_id", F.shiftleft(bucket, BUCKET_SHIFT) + F.monotonically_increasing_id())
            .withColumn("offset", F.lit(0).cast("long")))


def write_buckets(packed: DataFrame, path: str) -> None:
    """Write packed sequences in one folder per length.

    The rebalance gathers a bucket's rows into few files, and Spark splits a
    bucket that holds much of the data.
    """
    packed.hint("rebalance", "length").withColumn("bucket", F.col("length")).write.partitionBy("bucket").parquet(path)
