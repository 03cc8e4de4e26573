"""Approximate nearest neighbours by multi-index hashing of learned rotated binary codes.

A vector's code holds the signs of its components after several rotations, each
learned from a bounded sample so that the signs lie close to the rotated values.
Rows lie in blocks; in a block a code is cut into substrings, and each substring has
an index from value to rows. Two codes within r = m*a + b bits (m substrings, b < m)
agree to within a bits in one of the first b + 1 substrings or to within a - 1 in
one of the others. So probing the values at distance 0, 1, ... of each substring in
turn retrieves every code within a radius that grows until enough codes lie in it;
their vectors are then compared as they are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from carebook.llm.common import on_workers, stored

CODE_BITS = 256
SUBSTRING_BITS = 16
SAMPLE_VALUES = 20_000 * 64  # components of all vectors that the rotations are learned from
ROUNDS = 30
WANTED = 400  # codes within the radius, in a block
BLOCK_ROWS = 32_768
TASKS_A_CORE = 2
PROBES_AT_ONCE = 4  # substrings of one distance

_CODE_SCHEMA = "uid long, vec_id long, dim int, v array<double>, code binary"
_FOUND_SCHEMA = "query_uid long, query_id long, vec_id long, uid long, score double"


def usable(vectors: DataFrame) -> DataFrame:
    """``uid`` (a number of the row's own), ``vec_id``, ``dim`` and ``v`` of the rows that take part."""
    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < F.lit(float("inf"))))
    return (vectors.where(F.col("embedding").isNotNull() & fine & F.exists("embedding", lambda x: x != 0))
            .select(F.monotonically_increasing_id().alias("uid"), F.col("vec_id").cast("long").alias("vec_id"),
                    F.size("embedding").alias("dim"), F.col("embedding").cast("array<double>").alias("v")))


def _scaled(x: np.ndarray) -> np.ndarray:
    """Each vector times a power of two, so that no square leaves the range of a double; cosines stay the same to the bit."""
    return np.ldexp(x, -np.frexp(np.abs(x).max(1, keepdims=True))[1])


def _norms(x: np.ndarray) -> np.ndarray:
    return np.sqrt((x * x).sum(1))


def _units(x: np.ndarray) -> np.ndarray:
    x = _scaled(x)
    return x / _norms(x)[:, None]


def learned_rotations(sample: np.ndarray, bits: int = CODE_BITS, rounds: int = ROUNDS, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """(mean, projection) for codes of ``bits`` signs.

    The sample is centred and, where it has more directions than bits, cut to its
    principal ones. Each rotation starts at random and is improved in turns: signs
    of the rotated sample, then the rotation that takes the sample closest to these.
    """
    rng = np.random.default_rng(seed)
    dim = sample.shape[1]
    unit = _units(sample)
    mean = unit.mean(0)
    axes = np.linalg.eigh((unit - mean).T @ (unit - mean))[1][:, ::-1][:, :min(dim, bits)]
    near = (unit - mean) @ axes
    found = []
    for _ in range(-(-bits // axes.shape[1])):
        rotation = np.linalg.qr(rng.normal(size=(axes.shape[1], axes.shape[1])))[0]
        for _ in range(rounds if len(sample) > 1 else 0):
            left, _, right = np.linalg.svd(near.T @ np.where(near @ rotation > 0, 1.0, -1.0))
            rotation = left @ right
        found.append(axes @ rotation)
    return mean, np.concatenate(found, 1)[:, :bits]


def fitted(rows: DataFrame, bits: int = CODE_BITS, sample_values: int = SAMPLE_VALUES) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """The codes' projections, by dimension, from the rows whose uid has the smallest
    hashes, ``sample_values`` components at most in all."""
    widest = rows.agg(F.max("dim")).first()[0]
    if not widest:
        return {}
    picked = rows.orderBy(F.xxhash64("uid"), "uid").limit(max(1, sample_values // widest)).select("v").toArrow().column("v").combine_chunks()
    values, sizes = picked.values.to_numpy(), np.diff(picked.offsets.to_numpy())
    starts = picked.offsets.to_numpy()[:-1]
    return {dim: learned_rotations(values[starts[sizes == dim][:, None] + np.arange(dim)], bits) for dim in np.unique(sizes).tolist()}


def _unseen(dim: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Random directions, for vectors of a length that the sample does not hold."""
    return np.zeros(dim), np.random.default_rng(dim).normal(size=(dim, bits))


def _matrices(batch: pa.RecordBatch, column: str = "v") -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(dimension, rows, matrix) of the batch's vectors of each length."""
    lists = batch.column(column)
    offsets, values = lists.offsets.to_numpy(), lists.values.to_numpy()
    sizes = np.diff(offsets)
    for dim in np.unique(sizes).tolist():
        rows = np.flatnonzero(sizes == dim)
        yield dim, rows, values[offsets[rows][:, None] + np.arange(dim)].reshape(len(rows), dim)


def _code_batches(batches: Iterator[pa.RecordBatch], models: dict, bits: int) -> Iterator[pa.RecordBatch]:
    models = dict(models)
    for batch in batches:
        codes = np.empty(batch.num_rows, object)
        for dim, rows, matrix in _matrices(batch):
            if dim not in models:
                models[dim] = _unseen(dim, bits)
            mean, projection = models[dim]
            packed = np.packbits((_units(matrix) - mean) @ projection > 0, axis=1, bitorder="little")
            codes[rows] = [c.tobytes() for c in packed]
        yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in ("uid", "vec_id", "dim", "v")], pa.array(codes, pa.binary())],
                                         names=["uid", "vec_id", "dim", "v", "code"])


class Block:
    """Rows of one length with an index for each substring of their codes."""

    masks = [np.flatnonzero(np.bitwise_count(np.arange(1 << SUBSTRING_BITS, dtype=np.uint32)) == d) for d in range(SUBSTRING_BITS + 1)]

    def __init__(self, codes: np.ndarray, vectors: np.ndarray, vec_ids: np.ndarray, uids: np.ndarray):
        self.codes, self.vectors, self.vec_ids, self.uids = codes, vectors, vec_ids, uids
        self.norms = _norms(vectors)
        values = codes.view("<u2")
        self.size, self.substrings = values.shape
        self.order = np.empty((self.substrings, self.size), np.int32)
        self.starts = np.empty((self.substrings, (1 << SUBSTRING_BITS) + 1), np.int32)
        for j in range(self.substrings):
            self.order[j] = np.argsort(values[:, j], kind="stable")
            self.starts[j, 0] = 0
            np.cumsum(np.bincount(values[:, j], minlength=1 << SUBSTRING_BITS), out=self.starts[j, 1:])
        self.order = self.order.ravel()

    def _probe(self, code: np.ndarray, distance: int, first: int, last: int) -> np.ndarray:
        """Rows whose substring ``first`` .. ``last - 1`` is at this very distance from the code's; a row for each."""
        j = np.arange(first, last)[:, None]
        values = code[first:last, None] ^ self.masks[distance]
        low = self.starts[j, values]
        counts = self.starts[j, values + 1] - low
        hit = counts > 0
        low, counts = (low + j * self.size)[hit], counts[hit]
        ends = np.cumsum(counts)
        places = np.arange(ends[-1] if len(ends) else 0) + np.repeat(low - (ends - counts), counts)
        return self.order[places]

    def within(self, code: np.ndarray, wanted: int) -> np.ndarray:
        """Rows of every code within the least radius that holds ``wanted`` codes (all, if there are fewer)."""
        values, words = code.view("<u2").astype(np.int64), code.view("<u8")
        seen = np.zeros(self.size, bool)
        rows, distances, held = [], [], np.zeros(self.codes.shape[1] * 8 + 1, np.int64)
        wanted = min(wanted, self.size)
        for distance in range(SUBSTRING_BITS + 1):
            for first in range(0, self.substrings, PROBES_AT_ONCE):
                last = min(first + PROBES_AT_ONCE, self.substrings)
                fresh = self._probe(values, distance, first, last)
                fresh = np.unique(fresh[~seen[fresh]])
                seen[fresh] = True
                bits = np.bitwise_count(self.codes[fresh].view("<u8") ^ words).sum(1, dtype=np.int64)
                rows.append(fresh)
                distances.append(bits)
                held += np.bincount(bits, minlength=len(held))
                complete = min(self.substrings * distance + last - 1, len(held) - 1)  # every code within it is among the rows
                upto = np.cumsum(held[:complete + 1])
                if upto[-1] >= wanted:
                    radius = int(np.searchsorted(upto, wanted))
                    return np.concatenate(rows)[np.concatenate(distances) <= radius]
        return np.concatenate(rows)

    def nearest(self, code: np.ndarray, vector: np.ndarray, own_uid: int, wanted: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """The ``k`` rows of largest cosine among those within the radius, without the query's own, and their cosines."""
        rows = self.within(code, wanted + 1)
        rows = rows[self.uids[rows] != own_uid]
        cosines = (self.vectors[rows] * vector).sum(1) / (self.norms[rows] * _norms(vector[None]))
        best = np.lexsort((self.uids[rows], self.vec_ids[rows], -cosines))[:k]
        return rows[best], cosines[best]


def _search_batches(batches: Iterator[pa.RecordBatch], k: int, wanted: int) -> Iterator[pa.RecordBatch]:
    """Each (shard, share, dim) comes as its index rows and then its queries."""
    key, held, block = None, [], None
    missing = np.iinfo(np.int64).max  # a null vec_id comes last
    for batch in batches:
        if not batch.num_rows:
            continue
        shard, share, dims, asks = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("shard", "share", "dim", "query"))
        ids, uids = batch.column("vec_id").fill_null(missing).to_numpy(), batch.column("uid").to_numpy()
        change = np.flatnonzero((shard[1:] != shard[:-1]) | (share[1:] != share[:-1]) | (dims[1:] != dims[:-1]) | (asks[1:] != asks[:-1])) + 1
        for a, z in zip([0, *change], [*change, batch.num_rows]):
            here = (shard[a], share[a], dims[a])
            if here != key:
                key, held, block = here, [], None
            part = batch.slice(a, z - a)
            matrix = _scaled(next(_matrices(part))[2])
            codes = np.frombuffer(b"".join(part.column("code").to_pylist()), np.uint8).reshape(z - a, -1)
            if not asks[a]:
                held.append((codes, matrix, ids[a:z], uids[a:z]))
                continue
            if block is None:
                if not held:
                    continue
                block, held = Block(*(np.concatenate(x) for x in zip(*held))), []
            found = [block.nearest(codes[i], matrix[i], int(uids[a + i]), wanted, k) for i in range(z - a)]
            times = [len(rows) for rows, _ in found]
            rows = np.concatenate([r for r, _ in found])
            vec = block.vec_ids[rows]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(uids[a:z], times)), pa.array(np.repeat(ids[a:z], times)), pa.array(vec, mask=vec == missing),
                 pa.array(block.uids[rows]), pa.array(np.concatenate([s for _, s in found]))],
                names=["query_uid", "query_id", "vec_id", "uid", "score"])


def nearest(vectors: DataFrame, every: int = 50, k: int = 5, wanted: int = WANTED, bits: int = CODE_BITS, block_rows: int = BLOCK_ROWS,
            sample_values: int = SAMPLE_VALUES) -> DataFrame:
    """For each row whose vec_id is divisible by ``every``, the ``k`` nearest other rows found, by cosine.

    ``vectors`` has ``vec_id`` and ``embedding`` (array of float or double); other
    columns are not read. Returns ``query_id``, ``rank`` (from 1), ``vec_id`` and
    ``score``, the cosine of the vectors in doubles; equal scores are ranked by
    smaller vec_id (nulls last). Of every block of about ``block_rows`` rows all
    codes within a query's radius are compared, the radius being the least that
    holds ``wanted`` codes besides the query's own; so fewer candidates than k are
    all returned. Every row is indexed; the rotations are learned from
    ``sample_values`` components at most.

    A query's own row is no candidate; a row that repeats its vec_id is, and is a
    query of its own. Vectors that are null, empty or zero, or hold a null or
    non-finite component take no part, and vectors are compared with those of their
    own length. An empty table gives no rows. ``bits`` is a multiple of 64.

    A block's rows and the queries that meet it go to one task in that order, so a
    task holds one block and one batch of queries, however many vectors are alike.
    """
    if bits % 64:
        raise ValueError("bits must be a multiple of 64")
    rows = stored(usable(vectors), "vectors")
    models = fitted(rows, bits, sample_values)
    index = stored(rows.mapInArrow(on_workers(__name__, "_code_batches", models, bits), _CODE_SCHEMA), "codes")
    shards = max(1, -(-index.count() // block_rows))
    shares = max(1, -(-TASKS_A_CORE * vectors.sparkSession.sparkContext.defaultParallelism // shards))
    last = F.lit(shares - 1)
    asked = index.where(F.col("vec_id") % every == 0)
    held = (index.withColumn("shard", F.pmod(F.xxhash64("uid"), F.lit(shards)).cast("int"))
            .withColumn("share", F.explode(F.sequence(F.lit(0), last))).withColumn("query", F.lit(False)))
    asked = (asked.withColumn("share", F.pmod(F.xxhash64("uid"), F.lit(shares)).cast("int"))
             .withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))).withColumn("query", F.lit(True)))
    order = ["shard", "share", "dim", "query"]
    meeting = held.unionByName(asked).repartition(shards * shares, *order[:3]).sortWithinPartitions(*order)
    found = meeting.mapInArrow(on_workers(__name__, "_search_batches", k, wanted), _FOUND_SCHEMA)
    best = Window.partitionBy("query_uid").orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last(), "uid")
    return (found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
