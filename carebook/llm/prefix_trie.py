"""Conversation prefix trie from composable monoid fingerprints.

A turn has two 64-bit numbers u and b drawn from its key, u odd. A run of turns
has the product (U, S): U is the product of their u and S the sum of each b times
the U up to it, itself included, modulo 2^64; so one turn has (u, bu). Products
compose, (U, S)(V, T) = (UV, S + UT), and can be divided off, since U is odd. So the fingerprint of a rebuilt
conversation's prefix, some turns of a base and then the rest of its own, is put
together from prefix products of the stored conversations; no rebuilt text is
ever made. Prefixes with one depth and fingerprint are one node. That they are
equal is checked: all rows of a node must refer to the same stored turn and come
from the same parent node, and each key must stand for one stored (role, text).

What a node says of its subtree needs no walk. A node is owned by its smallest
member, and a member that owns one prefix owns all its longer ones. The owners of
the nodes below u are members of u, so a sum over u's subtree is a sum over u's
members of what they own, less what u's own owner has above u.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from carebook.llm.common import has_rows, on_workers, stored

EVERY = 20
HEADS = 4  # a base gives 0 to HEADS - 1 turns
SORT_CHARS = 64
DEPTH_BLOCK = 65_536
IDS_A_CHUNK = 4_096
ATTEMPTS = 4
EMPTY_SHA256 = hashlib.sha256(b"").hexdigest()
NODE = ["depth", "f1", "f2"]

_PRODUCT_SCHEMA = "conv long, seg int, at long, k1 long, k2 long, words long, u long, s long"
_HEAD = "depth: long, f1: long, f2: long, p1: long, p2: long, k1: long, k2: long, words: long"
_PLAN_SCHEMA = f"conv long, size long, head array<struct<{_HEAD}>>, segs array<struct<seg: int, p: long, q: long, skip: long, shift: long>>"
_PLACED = "conv long, seg int, depth long, f1 long, f2 long, p1 long, p2 long, k1 long, k2 long, words long, size long"
_MASK = (1 << 64) - 1


def _mixed(x: np.ndarray, salt: int) -> np.ndarray:
    """A well-spread 64-bit number for each 64-bit number."""
    x = x.astype(np.uint64, copy=True) + np.uint64((0x9E3779B97F4A7C15 * (salt + 1)) & _MASK)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def symbols(k1: np.ndarray, k2: np.ndarray, salt: int) -> tuple[np.ndarray, np.ndarray]:
    """u and b of each turn key."""
    return _mixed(k1.view(np.uint64), 2 * salt) | np.uint64(1), _mixed(k2.view(np.uint64), 2 * salt + 1)


def inverse(a: np.ndarray) -> np.ndarray:
    """Inverses of odd numbers modulo 2^64: each round doubles the right low bits."""
    x = a.copy()
    for _ in range(5):
        x *= np.uint64(2) - a * x
    return x


def _int64(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(name).to_numpy(zero_copy_only=False).astype(np.int64, copy=False)


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x).view(np.int64))


def _product_batches(batches: Iterator[pa.RecordBatch], salt: int) -> Iterator[pa.RecordBatch]:
    """Place and product of every turn within this partition's part of its conversation."""
    from pyspark import TaskContext
    part, conv, count, u_run, s_run = TaskContext.get().partitionId(), None, 0, np.uint64(1), np.uint64(0)
    one = np.ones(1, np.uint64)
    with np.errstate(over="ignore"):
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            convs, k1, k2 = (_int64(batch, c) for c in ("conv", "k1", "k2"))
            u, b = symbols(k1, k2, salt)
            new = np.ones(n, bool)
            new[0] = conv is None or convs[0] != conv
            new[1:] = convs[1:] != convs[:-1]
            first = np.flatnonzero(new)
            run = np.cumsum(new) - (1 if new[0] else 0)  # run 0 goes on from the last batch unless a new one starts here
            if new[0]:
                count, u_run, s_run = 0, np.uint64(1), np.uint64(0)
                first = first[1:]
            total = np.multiply.accumulate(u)
            factor = np.concatenate([one * u_run, inverse(total[first - 1])])
            product = total * factor[run]
            added = np.add.accumulate(b * product)
            s = added + np.concatenate([one * s_run, -added[first - 1]])[run]
            at = np.arange(1, n + 1) + np.concatenate([[count], -first])[run]
            conv, count, u_run, s_run = int(convs[-1]), int(at[-1]), product[-1], s[-1]
            yield pa.RecordBatch.from_arrays(
                [pa.array(convs), pa.array(np.full(n, part, np.int32)), pa.array(at), pa.array(k1), pa.array(k2), batch.column("words"),
                 _signed(product), _signed(s)], names=["conv", "seg", "at", "k1", "k2", "words", "u", "s"])


def _times(a: tuple[int, int], b: tuple[int, int]) -> tuple[int, int]:
    return a[0] * b[0] & _MASK, (a[1] + a[0] * b[1]) & _MASK


def _long(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _plan_batches(batches: Iterator[pa.RecordBatch], salt: int, heads: int) -> Iterator[pa.RecordBatch]:
    """How each conversation is rebuilt: its head's prefixes, and for each of its segments the
    product (p, q) before it, the places that are skipped and the shift from place to depth."""
    schema = None
    for batch in batches:
        rows = batch.to_pylist()
        turns = [t for r in rows for t in (r["base"] or [])[:heads - 1] + r["own"][:heads - 1]]
        with np.errstate(over="ignore"):
            u, b = symbols(np.array([t["k1"] for t in turns], np.int64), np.array([t["k2"] for t in turns], np.int64), salt)
            drawn = iter(zip(u.tolist(), (b * u).tolist()))
        out = {"conv": [], "size": [], "head": [], "segs": []}
        for r in rows:
            base = [(t, next(drawn)) for t in (r["base"] or [])[:heads - 1]]
            own = [next(drawn) for _ in r["own"][:heads - 1]]
            h = zlib.crc32(str(r["conv"]).encode()) % heads
            total = sum(s["last"]["at"] for s in r["segs"])
            at = (1, 0)
            head = [dict(depth=0, f1=1, f2=0, p1=0, p2=0, k1=0, k2=0, words=0)]
            for turn, product in base[:h]:
                parent, at = at, _times(at, product)
                head.append(dict(depth=len(head), f1=_long(at[0]), f2=_long(at[1]), p1=_long(parent[0]), p2=_long(parent[1]),
                                 k1=turn["k1"], k2=turn["k2"], words=turn["words"]))
            k = len(head) - 1
            left = (1, 0)  # the own turns that the head replaces
            for product in own[:h]:
                left = _times(left, product)
            g = at[0] * pow(left[0], -1, 1 << 64) & _MASK
            before, done, segs = (1, 0), 0, []
            for s in r["segs"]:
                segs.append(dict(seg=s["seg"], p=_long(g * before[0] & _MASK), q=_long((at[1] + g * (before[1] - left[1])) & _MASK),
                                 skip=h - done, shift=done - h + k))
                before = _times(before, (s["last"]["u"] & _MASK, s["last"]["s"] & _MASK))
                done += s["last"]["at"]
            for name, value in (("conv", r["conv"]), ("size", k + max(0, total - h)), ("head", head), ("segs", segs)):
                out[name].append(value)
        if schema is None:
            number = pa.int64()
            schema = pa.schema([
                ("conv", number), ("size", number),
                ("head", pa.list_(pa.struct([(n, number) for n in ("depth", "f1", "f2", "p1", "p2", "k1", "k2", "words")]))),
                ("segs", pa.list_(pa.struct([("seg", pa.int32()), ("p", number), ("q", number), ("skip", number), ("shift", number)])))])
        yield pa.RecordBatch.from_pydict(out, schema=schema)


def _place_batches(batches: Iterator[pa.RecordBatch], salt: int) -> Iterator[pa.RecordBatch]:
    """Own turns under the fingerprints of the rebuilt prefixes that they end."""
    with np.errstate(over="ignore"):
        for batch in batches:
            u, s, p, q = (_int64(batch, c).view(np.uint64) for c in ("u", "s", "p", "q"))
            u1, b1 = symbols(_int64(batch, "k1"), _int64(batch, "k2"), salt)
            f1 = p * u
            f2 = q + p * s
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv"), batch.column("seg"), pa.array(_int64(batch, "at") + _int64(batch, "shift")), _signed(f1), _signed(f2),
                 _signed(f1 * inverse(u1)), _signed(f2 - b1 * f1), *[batch.column(c) for c in ("k1", "k2", "words", "size")]],
                names=["conv", "seg", *NODE, "p1", "p2", "k1", "k2", "words", "size"])


def _turns(conversations: DataFrame, salt: int) -> DataFrame:
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    read = conversations.select(F.col("conv_id").cast("long").alias("conv"), F.col("turn").cast("long").alias("turn"),
                                role.alias("role"), text.alias("text")).where(F.col("conv").isNotNull())
    return read.withColumns({"k1": F.xxhash64(F.lit(salt), "role", "text"), "k2": F.xxhash64(F.lit(~salt), "text", "role")})


def _prefixes(conversations: DataFrame, salt: int, every: int) -> DataFrame | None:
    """(conv, seg, depth, node, parent, turn, size): every prefix of every rebuilt
    conversation, or None if two stored turns have one key."""
    turns = _turns(conversations, salt)
    # The shuffled texts are compared whole: one key, one (role, text).
    contents = turns.groupBy("k1", "k2", "role", "text").agg(F.lit(1).alias("_")).groupBy("k1", "k2").count()
    if has_rows(contents.where(F.col("count") > 1)):
        return None
    words = F.size(F.array_remove(F.split("text", r"[\x20\x09-\x0D]+"), "")).cast("long")
    order = ["conv", "turn", "_role", "_text", "k1", "k2"]
    keys = turns.select("conv", "turn", F.substring("role", 1, SORT_CHARS).alias("_role"), F.substring("text", 1, SORT_CHARS).alias("_text"),
                        "k1", "k2", words.alias("words"), F.monotonically_increasing_id().alias("_row"))
    products = stored(keys.repartitionByRange(*order, "_row").sortWithinPartitions(*order, "_row").select("conv", "k1", "k2", "words")
                      .mapInArrow(on_workers(__name__, "_product_batches", salt), _PRODUCT_SCHEMA), "turn-products")

    lead = F.when(F.col("at") < HEADS, F.struct("at", "k1", "k2", "words"))
    segments = (products.groupBy("conv", "seg").agg(F.max(F.struct("at", "u", "s")).alias("last"), F.array_sort(F.collect_list(lead)).alias("lead"))
                .groupBy("conv").agg(F.array_sort(F.collect_list(F.struct("seg", "last", "lead"))).alias("segs")))
    own = F.slice(F.flatten(F.transform("segs", lambda s: s["lead"])), 1, HEADS - 1)
    convs = stored(segments.select("conv", own.alias("own"), F.transform("segs", lambda s: F.struct(s["seg"].alias("seg"), s["last"].alias("last"))).alias("segs")),
                   "conversations")
    bases = convs.where(F.col("conv") % every == 0).select(F.col("conv").alias("_base"), F.col("own").alias("base"))
    plans = stored(convs.join(bases, F.col("conv") - F.col("conv") % every == F.col("_base"), "left").drop("_base")
                   .mapInArrow(on_workers(__name__, "_plan_batches", salt, HEADS), _PLAN_SCHEMA), "rebuilding")

    # A part of a conversation is at most a sorted partition, so this join has no hot key.
    parts = plans.select("conv", "size", F.explode("segs").alias("_seg")).select("conv", "size", "_seg.*")
    rest = (products.join(parts, ["conv", "seg"]).where(F.col("at") > F.col("skip"))
            .mapInArrow(on_workers(__name__, "_place_batches", salt), _PLACED))
    heads = plans.select("conv", F.lit(-1).alias("seg"), F.explode("head").alias("_head"), "size").select("conv", "seg", "_head.*", "size")
    return stored(rest.unionByName(heads), "prefixes")


def _nodes(prefixes: DataFrame) -> DataFrame | None:
    """Every node with its owner, or None if the rows of one fingerprint differ."""
    same = ["p1", "p2", "k1", "k2"]
    grouped = prefixes.groupBy(*NODE).agg(
        F.min("conv").alias("owner"), F.count(F.lit(1)).alias("n_convs"), F.max("words").alias("words"), F.max("size").alias("_longest"),
        *[F.min(c).alias(c) for c in same], *[F.max(c).alias(f"_{c}") for c in same])
    mixed = F.greatest(*[(F.col(c) != F.col(f"_{c}")).cast("int") for c in same]) == 1
    nodes = stored(grouped.select(*NODE, "owner", "n_convs", "p1", "p2", (F.col("_longest") == F.col("depth")).alias("childless"),
                                  ((F.col("n_convs") - 1) * F.col("words")).alias("saved"), mixed.alias("_mixed")), "trie-nodes")
    return None if has_rows(nodes.where("_mixed")) else nodes.drop("_mixed")


def _saved_above(nodes: DataFrame) -> DataFrame:
    """``nodes`` with ``above``: what the node's owner owns above the node. A long chain is summed in blocks of depth."""
    blocked = nodes.withColumn("_block", F.floor(F.col("depth") / DEPTH_BLOCK))
    chain = Window.partitionBy("owner").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    carried = (blocked.groupBy("owner", "_block").agg(F.sum("saved").alias("_sum")).withColumn("_carried", F.sum("_sum").over(chain))
               .where(F.col("_carried") > 0).select("owner", "_block", "_carried"))
    block = Window.partitionBy("owner", "_block").orderBy("depth").rowsBetween(Window.unboundedPreceding, -1)
    return (blocked.join(carried, ["owner", "_block"], "left")
            .withColumn("above", F.coalesce(F.sum("saved").over(block), F.lit(0)) + F.coalesce("_carried", F.lit(0)))
            .drop("_block", "_carried"))


def _chunk_batches(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """Runs of conversations that end in one node, comma-joined, ``size`` at most a row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [_int64(batch, c) for c in (*NODE, "conv")]
        new = np.ones(batch.num_rows, bool)
        new[1:] = np.any([c[1:] != c[:-1] for c in columns[:3]], axis=0)
        starts = np.flatnonzero(new)
        cuts = [a for start, end in zip(starts, [*starts[1:], batch.num_rows]) for a in range(start, end, size)]
        ids = list(map(str, columns[3].tolist()))
        yield pa.RecordBatch.from_arrays(
            [*[pa.array(c[cuts]) for c in columns], pa.array([",".join(ids[a:z]) for a, z in zip(cuts, [*cuts[1:], len(ids)])])],
            names=[*NODE, "first", "ids"])


def _digest_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each node's joined chunks; they come in order, one at a time is held."""
    key, state = None, None
    out: list[tuple] = []

    def flush() -> pa.RecordBatch:
        depth, f1, f2, digest = zip(*out)
        out.clear()
        return pa.RecordBatch.from_arrays([*[pa.array(c, pa.int64()) for c in (depth, f1, f2)], pa.array(digest)], names=[*NODE, "ends_sha256"])

    for batch in batches:
        for *node, ids in zip(*[batch.column(c).to_pylist() for c in (*NODE, "ids")]):
            if node != key:
                if key is not None:
                    out.append((*key, state.hexdigest()))
                key, state = node, hashlib.sha256()
            else:
                state.update(b",")
            state.update(ids.encode())
        if len(out) >= 10_000:
            yield flush()
    if key is not None:
        out.append((*key, state.hexdigest()))
    if out:
        yield flush()


def _end_digests(prefixes: DataFrame) -> DataFrame:
    """(node, ends_sha256) of the nodes in which conversations end. A node with many of them
    is cut over partitions, which write its numbers as text; only these chunks meet in order."""
    order = [*NODE, "conv"]
    ends = prefixes.where(F.col("depth") == F.col("size")).select(*order)
    chunks = ends.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(
        on_workers(__name__, "_chunk_batches", IDS_A_CHUNK), "depth long, f1 long, f2 long, first long, ids string")
    return (chunks.repartition(*NODE).sortWithinPartitions(*NODE, "first")
            .mapInArrow(on_workers(__name__, "_digest_batches"), "depth long, f1 long, f2 long, ends_sha256 string"))


def prefix_trie(conversations: DataFrame, every: int = EVERY) -> DataFrame:
    """Nodes of the trie of rebuilt conversations.

    ``conversations`` has ``conv_id``, ``turn``, ``role`` and ``text``; other columns
    are not read. Conversation c is rebuilt from the first h turns of conversation
    c - c % ``every`` (all if fewer, none if it is absent), h the unsigned crc32 of
    the decimal c modulo 4, and its own turns after its first h. A node is a distinct
    sequence of first turns (role, text); the root has none.

    Returns per node ``conv_id`` (its smallest member), ``depth``, ``parent_conv_id``
    (its parent's smallest member; null for the root), ``n_convs``, ``n_children``,
    ``n_leaves`` and ``saved_tokens`` (of its subtree, itself included) and
    ``ends_sha256`` (of the members that end there, comma-joined in numeric order).

    Turns go by ``turn``, null first; ties by the beginnings of role and text (64
    characters each) and then by hash, and repeated rows are turns each. A null role
    or text is empty. Rows with a null conv_id belong to no conversation. An empty
    table has no conversation and gives no rows. Texts of any length are read once
    for their words and once to be compared; only hashes go on.
    """
    for salt in range(ATTEMPTS):
        prefixes = _prefixes(conversations, salt, every)
        nodes = None if prefixes is None else _nodes(prefixes)
        if nodes is not None:
            break
    else:
        raise RuntimeError("fingerprints of different turns or prefixes keep colliding")

    chains = nodes.groupBy("owner").agg(F.min("depth").alias("top"), F.sum("saved").alias("owned"), F.max(F.col("childless").cast("int")).alias("leaf"))
    parts = prefixes.select("conv", "seg").distinct()
    owners = parts.join(chains, F.col("conv") == F.col("owner"), "left").drop("owner")
    child = (F.col("top") <= F.col("depth") + 1) & (F.col("depth") < F.col("size"))
    members = (prefixes.select("conv", "seg", *NODE, "size").join(owners, ["conv", "seg"]).groupBy(*NODE)
               .agg(F.min("top").alias("top"), F.sum("owned").alias("owned"), F.sum("leaf").alias("n_leaves"), F.count_if(child).alias("n_children")))
    whole = stored(_saved_above(nodes).drop("saved", "childless").join(members, NODE).join(_end_digests(prefixes), NODE, "left")
                   .withColumn("saved_tokens", F.col("owned") - F.col("above")), "trie")
    # Below its top a chain's parent has the same owner; only tops look theirs up.
    parents = nodes.select((F.col("depth") + 1).alias("_depth"), F.col("f1").alias("_f1"), F.col("f2").alias("_f2"), F.col("owner").alias("parent_conv_id"))
    is_top = (F.col("depth") == F.col("top")) & (F.col("depth") > 0)
    up = (F.col("depth") == F.col("_depth")) & (F.col("p1") == F.col("_f1")) & (F.col("p2") == F.col("_f2"))
    tops = whole.where(is_top).join(parents, up)
    rest = whole.where(~is_top).withColumn("parent_conv_id", F.when(F.col("depth") > 0, F.col("owner")))
    columns = [F.col("owner").alias("conv_id"), "depth", "parent_conv_id", "n_convs", "n_children", F.col("n_leaves").cast("long").alias("n_leaves"),
               "saved_tokens", F.coalesce("ends_sha256", F.lit(EMPTY_SHA256)).alias("ends_sha256")]
    return tops.select(*columns).unionByName(rest.select(*columns))


ORACLE = r"""
WITH t AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos
  FROM conversations WHERE conv_id IS NOT NULL
),
c AS (
  SELECT conv_id, conv_id - conv_id % 20 AS base,
         xor(list_reduce(list_concat([4294967295::UBIGINT], list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::UBIGINT)),
               lambda a, b: list_reduce(list_concat([xor(a, b)], [0::UBIGINT, 0, 0, 0, 0, 0, 0, 0]),
                 lambda r, z: xor(r >> 1, CASE WHEN r & 1 = 1 THEN 3988292384::UBIGINT ELSE 0::UBIGINT END))), 4294967295::UBIGINT) % 4 AS h
  FROM (SELECT DISTINCT conv_id FROM t)
),
head AS (SELECT c.conv_id, t.pos::BIGINT AS d, role, text FROM c JOIN t ON t.conv_id = c.base AND t.pos <= c.h),
k AS (SELECT c.conv_id, h, count(head.d) AS k FROM c LEFT JOIN head ON c.conv_id = head.conv_id GROUP BY ALL),
r AS (
  SELECT * FROM head UNION ALL
  SELECT k.conv_id, (pos - h::BIGINT + k)::BIGINT, role, text FROM k JOIN t ON k.conv_id = t.conv_id WHERE pos > h::BIGINT
),
p AS (
  SELECT conv_id, d, text, list({'role': role, 'text': text}) OVER (PARTITION BY conv_id ORDER BY d) AS prefix,
         count(*) OVER (PARTITION BY conv_id) AS size
  FROM r
  UNION ALL
  SELECT c.conv_id, 0, '', [], (SELECT count(*) FROM r WHERE r.conv_id = c.conv_id) FROM c
),
node AS (
  SELECT d, prefix, min(conv_id) AS conv_id, count(*) AS n_convs, max(size) = d AS leaf,
         (count(*) - 1) * len(list_filter(string_split_regex(any_value(text), '[\x20\x09-\x0D]+'), lambda x: x <> '')) AS saved,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE size = d), '')) AS ends_sha256
  FROM p GROUP BY d, prefix
),
above AS (SELECT leaf, saved, d, prefix, unnest(range(0, d + 1)) AS a FROM node),
below AS (
  SELECT a AS d, prefix[1:a] AS prefix, count(*) FILTER (WHERE leaf) AS n_leaves, sum(saved)::BIGINT AS saved_tokens,
         count(*) FILTER (WHERE d = a + 1) AS n_children
  FROM (SELECT a, d, leaf, saved, prefix FROM above) GROUP BY ALL
)
SELECT n.conv_id, n.d AS depth, up.conv_id AS parent_conv_id, n.n_convs, b.n_children, b.n_leaves, b.saved_tokens, n.ends_sha256
FROM node n JOIN below b ON n.d = b.d AND n.prefix = b.prefix LEFT JOIN node up ON up.d = n.d - 1 AND up.prefix = n.prefix[1:n.d - 1]
"""
