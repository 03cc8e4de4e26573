"""SimHash near-duplicates by a self-join of binary tries.

Fingerprints: one pass over the texts. Links: two fingerprints that differ in
at most d bits agree in full on one of any d + 1 blocks of their bits, so each
fingerprint goes once to the trie of every block, chosen by the block's value.
In each trie, pairs of nodes are followed down together from the root pair;
the differing bits so far are added up, and a pair of nodes is given up once
they exceed d. Leaves that meet are joined at once in a local forest, so a
trie hands on at most one edge per fingerprint, however many pairs it holds.
A block value shared by very many fingerprints is divided again by the blocks
of its remaining bits, until every trie is small; nothing is dropped.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carebook.llm.common import has_rows, keyed, on_workers, stored, text_key
from carebook.llm.components import connected_components
from carebook.llm.tokenizing import slices
from carebook.operators.broadcast import bounded_broadcast

BITS = 64
SEED = 42
WINDOW = 4 << 20
MAX_TRIE = 2_000
MAX_LISTED = 100_000
PAIRS_AT_ONCE = 1 << 19
_SPACE = re.compile(rb"[\x20\x09-\x0d]")


# ---- fingerprints -----------------------------------------------------------

def _hashes(words: list[bytes], size: int) -> np.ndarray:
    """XXH64 of each run of ``size`` words (all of them, if fewer)."""
    from xxhash import xxh64_intdigest
    joined = b" ".join(words)
    if len(words) <= size:
        runs = [joined]
    else:
        lengths = np.fromiter(map(len, words), np.int64, len(words)) + 1
        ends = np.cumsum(lengths)
        runs = [joined[a:b] for a, b in zip((ends - lengths)[:len(words) - size + 1].tolist(), (ends[size - 1:] - 1).tolist())]
    return np.fromiter(map(xxh64_intdigest, runs, repeat(SEED)), np.uint64, len(runs))


def _text_hashes(text: bytes, size: int) -> Iterator[np.ndarray]:
    """Shingle hashes of a whole text, a window of it at a time."""
    at, carry, found = 0, [], False
    while at < len(text):
        end = at + WINDOW
        if end < len(text):
            gap = _SPACE.search(text, end)
            end = gap.start() if gap else len(text)
        words = carry + text[at:end].lower().split()  # bytes: A-Z and ASCII white space only
        carry = words
        if len(words) >= size:
            yield _hashes(words, size)
            found, carry = True, words[len(words) - size + 1:]
        at = end
    if carry and not found:
        yield _hashes(carry, size)


# A byte as eight counters of eight bits each.
_SPREAD = np.array([sum((b >> i & 1) << 8 * i for i in range(8)) for b in range(256)], np.uint64)


def _fingerprints(texts: list[bytes | None], size: int) -> np.ndarray:
    counts = np.zeros((len(texts), BITS), np.int64)
    total = np.zeros(len(texts), np.int64)
    owners: list[int] = []
    parts: list[np.ndarray] = []
    held = 0

    def add() -> None:
        nonlocal held
        if not parts:
            return
        lengths = np.array([len(p) for p in parts])
        owner = np.array(owners)
        np.add.at(total, owner, lengths)
        blocks = -(-lengths // 255)  # eight-bit counters hold 255 rows
        of = np.repeat(np.arange(len(parts)), blocks)
        place = np.arange(len(of)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
        starts = (np.cumsum(lengths) - lengths)[of] + 255 * place
        spread = _SPREAD[np.concatenate(parts).astype("<u8").view(np.uint8).reshape(-1, 8)]
        sums = np.add.reduceat(spread, starts, axis=0).astype("<u8").view(np.uint8).reshape(-1, BITS)
        np.add.at(counts, owner[of], sums)
        owners.clear()
        parts.clear()
        held = 0

    for i, text in enumerate(texts):
        for hashes in _text_hashes(text or b"", size):
            owners.append(i)
            parts.append(hashes)
            held += len(hashes)
            if held > 1 << 18:
                add()
    add()
    bits = (2 * counts > total[:, None]).astype(np.uint8)
    return np.packbits(bits, axis=1, bitorder="little").view("<u8").reshape(-1)


def _fingerprint_batches(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text", 4 << 20):
            values = _fingerprints(part.column("text").cast(pa.large_binary()).to_pylist(), size)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("text_key"), pa.array(values.view(np.int64))],
                names=["doc_id", "text_key", "fingerprint"])


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """``doc_id``, ``text_key`` (hash of the text) and 64-bit ``fingerprint`` (long) of each row.

    Words are runs without ASCII white space, A-Z in lower case; shingles are
    ``shingle`` words joined by a space, repeats included; a text with fewer
    words is one shingle, one without words has fingerprint 0. A bit is 1 if it
    is set in over half of the shingles' XXH64 values (seed 42).
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.withColumn("text_key", text_key(F.col("text"))).mapInArrow(
        on_workers(__name__, "_fingerprint_batches", shingle), "doc_id long, text_key long, fingerprint long")


# ---- the trie self-join -----------------------------------------------------

def _unite(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Join the trees of ``label`` (each node to its least) along the links i-j."""
    while True:
        a, b = label[i], label[j]
        apart = a != b
        if not apart.any():
            return
        i, j, a, b = i[apart], j[apart], a[apart], b[apart]
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while True:
            up = label[label]
            if np.array_equal(up, label):
                break
            label[:] = up


def trie_links(values: np.ndarray, groups: np.ndarray, budget: int) -> np.ndarray:
    """Least linked member of each entry's component, within its group.

    ``values`` are distinct uint64 in ascending order inside each group, and
    groups are contiguous: a trie node is a range of entries that share their
    leading bits, and its two children are cut where the next bit turns to 1.
    """
    n = len(values)
    label = np.arange(n)
    starts = np.flatnonzero(np.concatenate([[True], groups[1:] != groups[:-1]])) if n else np.zeros(0, np.int64)
    ends = np.append(starts[1:], n) if n else starts
    several = ends - starts > 1
    ones: dict[int, np.ndarray] = {}
    first = (starts[several], ends[several], starts[several], ends[several], np.zeros(int(several.sum()), np.int64))
    stack = [(BITS - 1, first)]
    while stack:
        bit, (alo, ahi, blo, bhi, differing) = stack.pop()
        # Two single leaves: compare them outright.
        single = (ahi - alo == 1) & (bhi - blo == 1)
        if single.any():
            i, j = alo[single], blo[single]
            near = differing_bits(values[i], values[j]) <= budget
            _unite(label, i[near], j[near])
            keep = ~single
            alo, ahi, blo, bhi, differing = alo[keep], ahi[keep], blo[keep], bhi[keep], differing[keep]
        if not len(alo) or bit < 0:
            continue
        if bit not in ones:
            ones[bit] = np.concatenate([[0], np.cumsum((values >> np.uint64(bit) & np.uint64(1)).astype(np.int64))])
        up = ones[bit]
        amid, bmid = ahi - (up[ahi] - up[alo]), bhi - (up[bhi] - up[blo])
        lo, hi, lo2, hi2, diff = _children(alo, amid, ahi, blo, bmid, bhi, differing, alo != blo)
        keep = (hi > lo) & (hi2 > lo2) & (diff <= budget) & ~((lo == lo2) & (hi - lo == 1))
        lo, hi, lo2, hi2, diff = lo[keep], hi[keep], lo2[keep], hi2[keep], diff[keep]
        for at in range(0, len(lo), PAIRS_AT_ONCE):
            cut = slice(at, at + PAIRS_AT_ONCE)
            stack.append((bit - 1, (lo[cut], hi[cut], lo2[cut], hi2[cut], diff[cut])))
    return label


def _children(alo, amid, ahi, blo, bmid, bhi, differing, other):
    """Pairs of child nodes; a node with itself gives three, two nodes give four."""
    pairs = [
        (alo, amid, blo, bmid, differing),                              # 0 and 0
        (amid, ahi, bmid, bhi, differing),                              # 1 and 1
        (alo, amid, bmid, bhi, differing + 1),                          # 0 and 1
        (amid[other], ahi[other], blo[other], bmid[other], differing[other] + 1),  # 1 and 0
    ]
    return [np.concatenate(x) for x in zip(*pairs)]


def differing_bits(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b)


def _trie_batches(batches: Iterator[pa.RecordBatch], budget: int) -> Iterator[pa.RecordBatch]:
    """Rows (mask, key, fingerprint) sorted by (mask, key); a group may run over batches."""
    held = np.zeros((0, 3), np.int64)

    def edges(rows: np.ndarray) -> pa.RecordBatch:
        values = np.ascontiguousarray(rows[:, 2]).view(np.uint64)
        change = np.concatenate([[True], (rows[1:, :2] != rows[:-1, :2]).any(1)]) if len(rows) else np.zeros(0, bool)
        group = np.cumsum(change)
        order = np.lexsort((values, group))
        values, group = values[order], group[order]
        label = trie_links(values, group, budget)
        linked = np.flatnonzero(label != np.arange(len(label)))
        return pa.RecordBatch.from_arrays([pa.array(values[linked].view(np.int64)), pa.array(values[label[linked]].view(np.int64))],
                                          names=["u", "v"])

    for batch in batches:
        rows = np.stack([batch.column(i).to_numpy() for i in range(3)], axis=1)
        held = np.concatenate([held, rows])
        last = np.flatnonzero((held[:, :2] != held[-1, :2]).any(1)) if len(held) else np.zeros(0, np.int64)
        if len(last):
            cut = int(last[-1]) + 1
            yield edges(held[:cut])
            held = held[cut:]
    yield edges(held)


def _as_long(mask: int) -> int:
    return mask - (1 << BITS) if mask >> (BITS - 1) else mask


def block_masks(fixed: int, blocks: int) -> list[int]:
    """``fixed`` with each of ``blocks`` runs of the bits it leaves free added; as unsigned masks."""
    free = [b for b in range(BITS) if not fixed >> b & 1]
    cuts = [len(free) * i // blocks for i in range(blocks + 1)]
    return [fixed | sum(1 << b for b in free[a:z]) for a, z in zip(cuts, cuts[1:])]


def links(distinct: DataFrame, max_distance: int, max_trie: int = MAX_TRIE) -> DataFrame:
    """Edges (u, v) that connect all fingerprints within ``max_distance`` bits of each other.

    ``distinct`` has one column ``fingerprint`` (long) without repeats. The
    edges span the components; they are not all pairs.
    """
    blocks = max_distance + 1
    masks = block_masks(0, blocks)
    spread = distinct.select("fingerprint", F.explode(F.array(*[F.lit(_as_long(m)) for m in masks])).alias("mask"))
    ready = None
    while True:
        spread = spread.withColumn("key", F.col("fingerprint").bitwiseAND(F.col("mask")))
        # Beyond this many fixed bits a trie cannot exceed the bound, or cannot be divided further.
        free = BITS - max(bin(m).count("1") for m in masks)
        if 2 ** free <= max_trie or free < blocks:
            break
        large = spread.groupBy("mask", "key").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > max_trie).select("mask", "key")
        large = stored(large, "large-tries")
        if not has_rows(large):
            break
        large = bounded_broadcast(large, MAX_LISTED)
        done = spread.join(large, ["mask", "key"], "left_anti")
        ready = done if ready is None else ready.unionByName(done)
        divided = F.create_map(*[F.lit(x) if isinstance(x, int) else x for m in masks for x in (
            _as_long(m), F.array(*[F.lit(_as_long(c)) for c in block_masks(m, blocks)]))])
        spread = spread.join(large, ["mask", "key"], "left_semi").select(
            "fingerprint", F.explode(divided[F.col("mask")]).alias("mask")).distinct()  # two masks may divide into the same one
        masks = sorted({c for m in masks for c in block_masks(m, blocks)})
    tries = spread if ready is None else ready.unionByName(spread)
    return (tries.select("mask", "key", "fingerprint").repartition("mask", "key").sortWithinPartitions("mask", "key")
            .mapInArrow(on_workers(__name__, "_trie_batches", max_distance), "u long, v long"))


# ---- near-duplicates --------------------------------------------------------

def near_duplicates(docs: DataFrame, shingle: int = 3, max_distance: int = 2) -> DataFrame:
    """Component of every row of ``docs`` (``doc_id``, ``text``; other columns are not read).

    Returns one row per row: ``doc_id``, ``text_key`` (hash of the text),
    ``fingerprint`` (16 hex digits), ``component_id`` (smallest doc_id that can
    be reached over links of at most ``max_distance`` differing bits, itself
    included) and ``component`` (the component's own key, never null).

    Texts with equal fingerprints are one node, so a group of copies costs one
    row after a partial aggregate. Null and empty texts have fingerprint 0 and
    are linked like any other. A null doc_id takes part; ``component_id`` is
    the smallest doc_id that is not null, and null if there is none. Repeated
    rows each get their row. An empty table gives no rows.
    """
    if not 0 <= max_distance < 8:
        raise ValueError("max_distance must be from 0 to 7")
    prints = stored(fingerprints(docs, shingle), "fingerprints")
    nodes = stored(prints.groupBy("fingerprint").agg(F.min("doc_id").alias("least_id")), "nodes")
    reached = connected_components(links(nodes.select("fingerprint"), max_distance))
    linked = nodes.join(reached.withColumnRenamed("node", "fingerprint"), "fingerprint")
    least = linked.groupBy("component").agg(F.min("least_id").alias("_least"))
    linked = linked.join(least, "component").select("fingerprint", "component", "_least")
    named = stored(nodes.join(linked, "fingerprint", "left").select(
        "fingerprint", F.coalesce("component", "fingerprint").alias("component"),
        F.when(F.col("component").isNull(), F.col("least_id")).otherwise(F.col("_least")).alias("component_id")), "named")
    # A table on either side: Spark can split the rows of a fingerprint that very many texts share.
    return prints.join(named, "fingerprint").select(
        "doc_id", "text_key", F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), "component_id", "component")


def one_per_component(docs: DataFrame, shingle: int = 3, max_distance: int = 2) -> DataFrame:
    """The rows of ``docs`` that stay when each component keeps one document.

    The document that stays is the one with the smallest doc_id (nulls last),
    then the smallest text hash. Rows that repeat its doc_id and text go too.
    Columns are those of ``docs``.
    """
    found = near_duplicates(docs, shingle, max_distance)
    order = F.struct(F.col("doc_id").isNull().alias("a"), F.col("doc_id").alias("b"), F.col("text_key").alias("c"))
    per_text = found.groupBy("component", "doc_id", "text_key").agg(F.count(F.lit(1)).alias("_copies"))
    best = per_text.groupBy("component").agg(F.min(F.struct(order.alias("o"), F.col("_copies").alias("n"))).alias("_best"))
    keepers = best.select(F.col("_best.o.b").alias("_id"), F.col("_best.o.c").alias("_key"), F.col("_best.n").alias("_copies"))
    kept = keyed(docs).join(keepers, F.col("key_id").eqNullSafe(F.col("_id")) & (F.col("key_text") == F.col("_key")))
    again = kept.where("_copies > 1").dropDuplicates(["key_id", "key_text"])
    return kept.where("_copies = 1").unionByName(again).select("row.*")
