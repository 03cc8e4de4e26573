"""Exact top-k by a bit-sliced index.

Rows lie in blocks. In a block every attribute (one component, quantised) is a
set of bitmaps, one per binary digit of its offset from the block's smallest
value. A query's score is a weighted sum of attributes: for each attribute and
each digit of the weight, the attribute's slices are added, shifted by that
digit, with full adders on whole bitmaps; a negative weight takes the inverted
slices. The sum comes out as slices again, and the best rows are picked from
the most significant slice downward: rows that must be in, and rows still tied.
Ties left at the last slice are broken by vec_id, which is the bit order.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from carebook.llm.common import on_workers, stored

SCALE = 64
BLOCK_ROWS = 65_536
QUERIES_AT_ONCE = 64
TASKS_A_CORE = 4
MAX_SUM = 2.0 ** 62  # what a sum of products may reach in a long, with room for the slices' offsets

_BLOCK_SCHEMA = "dim int, size int, vec_ids binary, uids binary, lows binary, slice_counts binary, slices binary"
_QUERY_SCHEMA = "dim int, query_ids binary, query_uids binary, weights binary"
_FOUND_SCHEMA = "query_uid long, query_id long, vec_id long, uid long, score long"


def quantised(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """``uid`` (a number of the row's own), ``vec_id`` and ``q``: floor(scale * x) of each component.

    Rows take no part if the vector is null or has a component that is null or not finite.
    """
    scaled = F.transform("embedding", lambda x: F.floor(F.lit(float(scale)) * x.cast("double")))
    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < F.lit(float("inf"))))
    return (vectors.where(F.col("embedding").isNotNull() & fine)
            .select(F.monotonically_increasing_id().alias("uid"), F.col("vec_id").cast("long").alias("vec_id"), scaled.alias("q")))


def check_range(rows: DataFrame) -> None:
    """Raise if an inner product of ``rows`` (see ``quantised``) could leave the range of a long.

    By Cauchy's inequality none does while every vector's squared length stays below
    MAX_SUM, half of it for the offsets from a block's smallest values.
    """
    length = F.aggregate("q", F.lit(0.0), lambda a, x: a + F.pow(x.cast("double"), F.lit(2)))
    most, widest = rows.agg(F.max(length), F.max(F.size("q") * F.pow(F.array_max(F.transform("q", lambda x: F.abs(x.cast("double")))), F.lit(2)))).first()
    if most is not None and max(most, (widest or 0.0) * 4) >= MAX_SUM:
        raise ValueError("quantised components are too large: an inner product would leave the range of a long; divide the vectors by a common factor")


def _matrix(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(dimension, rows, values) of the batch's vectors of each dimension."""
    lists = batch.column("q")
    offsets = lists.offsets.to_numpy()
    values = lists.values.to_numpy()
    sizes = np.diff(offsets)
    for dim in np.unique(sizes).tolist():
        rows = np.flatnonzero(sizes == dim)
        yield dim, rows, values[offsets[rows][:, None] + np.arange(dim)].reshape(len(rows), dim)


def _slices(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Smallest value of each column, number of slices, and all slices (bit r of a slice: row r)."""
    words = -(-len(values) // 64)
    lows = values.min(0).astype(np.int64)
    raised = values - lows
    counts = np.array([int(m).bit_length() for m in raised.max(0)], np.int64)
    out = np.zeros((int(counts.sum()), words * 8), np.uint8)
    at = 0
    for column, n in enumerate(counts.tolist()):
        for digit in range(n):
            bits = np.packbits((raised[:, column] >> digit & 1).astype(np.uint8), bitorder="little")
            out[at, :len(bits)] = bits
            at += 1
    return lows, counts, out.view("<u8")


def _index_batches(batches: Iterator[pa.RecordBatch], block_rows: int) -> Iterator[pa.RecordBatch]:
    held: dict[int, list] = {}

    def block(dim: int) -> pa.RecordBatch:
        ids, uids, values, missing = (np.concatenate(x) for x in zip(*held.pop(dim)))
        order = np.lexsort((uids, ids, missing))  # bit order: vec_id, null ids last
        lows, counts, slices = _slices(values[order]) if dim else (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros((0, 0), np.uint64))
        ids = np.where(missing, np.iinfo(np.int64).max, ids)
        return pa.RecordBatch.from_arrays(
            [pa.array([dim], pa.int32()), pa.array([len(order)], pa.int32()),
             *[pa.array([x.tobytes()]) for x in (ids[order], uids[order], lows, counts, slices)]],
            names=["dim", "size", "vec_ids", "uids", "lows", "slice_counts", "slices"])

    for batch in batches:
        ids = batch.column("vec_id").fill_null(0).to_numpy()
        missing = batch.column("vec_id").is_null().to_numpy(zero_copy_only=False)
        uids = batch.column("uid").to_numpy()
        for dim, rows, values in _matrix(batch):
            for a in range(0, len(rows), block_rows):
                cut = slice(a, a + block_rows)
                held.setdefault(dim, []).append((ids[rows[cut]], uids[rows[cut]], values[cut], missing[rows[cut]]))
                if sum(len(x[0]) for x in held[dim]) >= block_rows:
                    yield block(dim)
    for dim in list(held):
        yield block(dim)


def build_index(rows: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """One row per block of at most about ``block_rows`` (twice, at most) of ``rows`` (see ``quantised``)."""
    return rows.mapInArrow(on_workers(__name__, "_index_batches", block_rows), _BLOCK_SCHEMA)


def _query_batches(batches: Iterator[pa.RecordBatch], at_once: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, uids = batch.column("vec_id").to_numpy(), batch.column("uid").to_numpy()
        for dim, rows, values in _matrix(batch):
            for a in range(0, len(rows), at_once):
                cut = rows[a:a + at_once]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([dim], pa.int32()), *[pa.array([x.tobytes()]) for x in (ids[cut], uids[cut], values[a:a + at_once].astype(np.int64))]],
                    names=["dim", "query_ids", "query_uids", "weights"])


class Block:
    """A block's slices, and the arithmetic on them."""

    def __init__(self, size: int, vec_ids: bytes, uids: bytes, lows: bytes, counts: bytes, slices: bytes):
        self.size = size
        self.vec_ids, self.uids = np.frombuffer(vec_ids, np.int64), np.frombuffer(uids, np.int64)
        self.lows, counts = np.frombuffer(lows, np.int64), np.frombuffer(counts, np.int64)
        self.words = -(-size // 64)
        self.slices = np.frombuffer(slices, np.uint64).reshape(-1, self.words) if len(slices) else np.zeros((0, self.words), np.uint64)
        self.inverted = ~self.slices
        self.upto = np.concatenate([[0], np.cumsum(counts)])
        self.tops = (np.int64(1) << counts) - 1
        self.all = np.zeros(self.words * 8, np.uint8)
        whole = np.packbits(np.ones(size, np.uint8), bitorder="little")
        self.all[:len(whole)] = whole
        self.all = self.all.view("<u8")
        self.by_uid = np.argsort(self.uids)
        self.free: list[np.ndarray] = []

    def _fresh(self) -> np.ndarray:
        return self.free.pop() if self.free else np.empty(self.words, np.uint64)

    def sum_slices(self, weights: np.ndarray) -> tuple[list[np.ndarray | None], int]:
        """Slices of sum(weight * attribute) - shift, and the shift.

        With w < 0, w * a = |w| * (top - a) - |w| * top, and top - a has the
        inverted slices of a.
        """
        shift = int((weights * self.lows).sum()) - int((np.abs(weights) * self.tops)[weights < 0].sum())
        pending: dict[int, list[tuple[np.ndarray, bool]]] = {}
        for column in np.flatnonzero((weights != 0) & (self.tops > 0)).tolist():
            weight = int(weights[column])
            source = self.slices if weight > 0 else self.inverted
            first, last = int(self.upto[column]), int(self.upto[column + 1])
            weight = abs(weight)
            while weight:
                low = weight & -weight
                digit = low.bit_length() - 1
                weight ^= low
                for s in range(first, last):
                    pending.setdefault(digit + s - first, []).append((source[s], False))
        out: list[np.ndarray | None] = []
        place = 0
        scratch = self._fresh()
        while pending:
            here = pending.pop(place, [])
            above = pending.setdefault(place + 1, []) if len(here) > 1 else None
            while len(here) > 2:  # full adder: three bitmaps become a sum and a carry
                (a, own_a), (b, own_b), (c, own_c) = here.pop(), here.pop(), here.pop()
                total, carry = self._fresh(), self._fresh()
                np.bitwise_xor(a, b, out=scratch)
                np.bitwise_xor(scratch, c, out=total)
                np.bitwise_and(scratch, c, out=scratch)
                np.bitwise_and(a, b, out=carry)
                np.bitwise_or(carry, scratch, out=carry)
                self.free += [x for x, own in ((a, own_a), (b, own_b), (c, own_c)) if own]
                here.insert(0, (total, True))
                above.append((carry, True))
            if len(here) == 2:  # half adder
                (a, own_a), (b, own_b) = here
                total, carry = self._fresh(), self._fresh()
                np.bitwise_xor(a, b, out=total)
                np.bitwise_and(a, b, out=carry)
                self.free += [x for x, own in ((a, own_a), (b, own_b)) if own]
                here = [(total, True)]
                above.append((carry, True))
            out.append(here[0] if here else None)
            if place + 1 in pending and not pending[place + 1]:
                pending.pop(place + 1)
            place += 1
        self.free.append(scratch)
        return out, shift

    def top(self, weights: np.ndarray, own_uid: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Rows of the ``k`` best scores without the query's own row, and the scores."""
        sums, shift = self.sum_slices(weights)
        tied, sure = self.all.copy(), np.zeros(self.words, np.uint64)
        at = np.searchsorted(self.uids, own_uid, sorter=self.by_uid)
        if at < self.size and self.uids[self.by_uid[at]] == own_uid:
            own = int(self.by_uid[at])
            tied[own // 64] &= ~(np.uint64(1) << np.uint64(own % 64))
        n_sure = 0
        for item in reversed(sums):
            if item is None:
                continue
            ones = tied & item[0]
            n = n_sure + int(np.bitwise_count(ones).sum())
            if n > k:
                tied = ones
                continue
            sure |= ones
            n_sure = n
            tied &= ~item[0]
            if n == k:
                tied[:] = 0
                break
        rows = _rows(sure)
        if n_sure < k:  # what is still tied has one score: the smallest vec_ids
            rows = np.concatenate([rows, _rows(tied)[:k - n_sure]])
        scores = np.full(len(rows), shift, np.int64)
        for digit, item in enumerate(sums):
            if item is not None:
                scores += (item[0][rows // 64] >> (rows % 64).astype(np.uint64) & np.uint64(1)).astype(np.int64) << digit
        self.free += [item[0] for item in sums if item is not None and item[1]]
        return rows, scores


def _rows(bitmap: np.ndarray) -> np.ndarray:
    """Numbers of the rows whose bit is set."""
    words = np.flatnonzero(bitmap)
    bits = np.unpackbits(bitmap[words].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    word, bit = np.nonzero(bits)
    return words[word] * 64 + bit


def _search_batches(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    kept, block = None, None
    for batch in batches:
        for row in range(batch.num_rows):
            dim, size, vec_ids, uids, lows, counts, slices, query_ids, query_uids, weights = (
                batch.column(c)[row].as_py() for c in ("dim", "size", "vec_ids", "uids", "lows", "slice_counts", "slices",
                                                       "query_ids", "query_uids", "weights"))
            if kept != uids:
                kept, block = uids, Block(size, vec_ids, uids, lows, counts, slices)
            ids, own = np.frombuffer(query_ids, np.int64), np.frombuffer(query_uids, np.int64)
            matrix = np.frombuffer(weights, np.int64).reshape(len(ids), dim)
            found = [block.top(matrix[i], int(own[i]), k) for i in range(len(ids))]
            times = [len(rows) for rows, _ in found]
            rows = np.concatenate([r for r, _ in found])
            last = np.iinfo(np.int64).max
            vec = block.vec_ids[rows]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(own, times)), pa.array(np.repeat(ids, times)), pa.array(vec, mask=vec == last),
                 pa.array(block.uids[rows]), pa.array(np.concatenate([s for _, s in found]))],
                names=["query_uid", "query_id", "vec_id", "uid", "score"])


def top_k(vectors: DataFrame, every: int = 20, k: int = 20, scale: int = SCALE, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """For each row whose vec_id is divisible by ``every``, the ``k`` best other rows.

    ``vectors`` has ``vec_id`` and ``embedding`` (array of float or double);
    other columns are not read. Returns ``query_id``, ``rank`` (from 1),
    ``vec_id`` and ``score``, the inner product of the quantised vectors; equal
    scores are ranked by smaller vec_id (nulls last). A query's own row is no
    candidate; a row that repeats its vec_id is, and is a query of its own.
    Vectors that are null, or hold a null or non-finite component
    take no part, and vectors are compared with those of their own length. An
    empty table gives no rows; fewer than k candidates are all returned. A table
    whose inner products could leave the range of a long raises (``check_range``).

    Every block of queries meets every block of the index once. A pair yields
    at most k rows per query, and Spark keeps the best k of these before and
    after the shuffle.
    """
    rows = stored(quantised(vectors, scale), "quantised")
    check_range(rows)
    index = stored(build_index(rows.repartition(max(1, -(-rows.count() // block_rows))), block_rows), "bit-sliced")
    queries = rows.where(F.col("vec_id") % every == 0).mapInArrow(on_workers(__name__, "_query_batches", QUERIES_AT_ONCE), _QUERY_SCHEMA)
    # Pairs of blocks meet by an ordinary join on a number for the index block and,
    # while there are fewer blocks than tasks, one for a share of the queries.
    shards = max(1, index.count())
    shares = max(1, -(-TASKS_A_CORE * vectors.sparkSession.sparkContext.defaultParallelism // shards))
    index = index.withColumn("shard", F.pmod(F.xxhash64("uids"), F.lit(shards)).cast("int")).withColumn(
        "share", F.explode(F.sequence(F.lit(0), F.lit(shares - 1))))
    queries = queries.withColumn("share", F.pmod(F.xxhash64("query_uids"), F.lit(shares)).cast("int")).withColumn(
        "shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    key = ["shard", "share", "dim"]
    pairs = index.repartition(shards * shares, *key).join(queries.repartition(shards * shares, *key), key).drop("shard", "share")
    found = pairs.mapInArrow(on_workers(__name__, "_search_batches", k), _FOUND_SCHEMA)
    best = Window.partitionBy("query_uid").orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last(), "uid")
    return (found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


ORACLE = """
WITH v AS (
  SELECT row_number() OVER () AS uid, vec_id, len(embedding) AS dim,
         list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS q FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
s AS (
  SELECT a.uid AS query_uid, a.vec_id AS query_id, b.uid, b.vec_id,
         coalesce(list_sum(list_transform(range(1, a.dim + 1), lambda i: a.q[i] * b.q[i])), 0)::BIGINT AS score
  FROM v a JOIN v b ON a.dim = b.dim AND a.uid <> b.uid WHERE a.vec_id % 20 = 0
)
SELECT query_id, row_number() OVER (PARTITION BY query_uid ORDER BY score DESC, vec_id NULLS LAST, uid)::INTEGER AS rank, vec_id, score
FROM s QUALIFY rank <= 20
"""
