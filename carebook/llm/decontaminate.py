"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment.

The test items are the stated query set; the n-grams of an item are its seeds.
A seed that few items hold is rare: where a document holds one, the passage around
it may be the item. One that many items hold (an opening that questions share)
says little: it takes a second seed that puts the item at about the same place.
Before a passage is aligned it must hold enough of the item's words for the
score that counts, whatever their order; so what is aligned are near copies, and
their number does not grow as documents times items. The alignment, word by word,
counts equal words against edits, so paraphrased and edited copies score high and
chance meetings do not. Items are taken in blocks whose seeds have a bounded size,
and each block meets every document.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carebook.llm.common import on_workers, rows_without, stored, text_key
from carebook.llm.tokenizing import slices

SEED_WORDS = 3
RARE_ITEMS = 20  # a seed of more items of a block is common
MATCH, MISMATCH, GAP = 2, -1, -1
MIN_SCORE = 0.5
BLOCK_WORDS = 1_000_000
SLICE = 4 << 20
CELLS = 50_000  # passage words aligned side by side
CHECKED = 500_000  # words of passages and items compared at a time
_BREAK = r"[^\p{L}\p{M}\p{N}]+"
_P = np.uint64(0x9E3779B97F4A7C15)


# ---- words and n-grams ------------------------------------------------------

def _word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets of each text and the hashes of its words: runs of letters and digits, in lower case."""
    from xxhash import xxh64_intdigest
    lists = pc.split_pattern_regex(pc.utf8_lower(texts.cast(pa.string()).fill_null("")), _BREAK)
    offsets = lists.offsets.to_numpy().astype(np.int64)
    words = pc.list_flatten(lists).dictionary_encode()
    vocabulary = words.dictionary.to_pylist()
    hashes = np.fromiter(map(xxh64_intdigest, vocabulary, repeat(0)), np.uint64, len(vocabulary))
    empty = np.fromiter((not w for w in vocabulary), bool, len(vocabulary))
    index = words.indices.to_numpy()
    there = ~empty[index]
    upto = np.concatenate([[0], np.cumsum(there)])
    return upto[offsets - offsets[0]], hashes[index[there]]


def _grams(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of the ``size`` words from each position on."""
    n = max(0, len(words) - size + 1)
    out = np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        for i in range(size):
            out = (out ^ words[i:i + n]) * _P
            out ^= out >> np.uint64(31)
    return out


def _starts_inside(offsets: np.ndarray, size: int) -> np.ndarray:
    """Whether the ``size`` words from each position on lie in one text."""
    n = int(offsets[-1])
    end = np.repeat(offsets[1:], np.diff(offsets))
    return np.arange(n) + size <= end


def _places(sorted_keys: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    if not len(sorted_keys):
        return np.full(len(wanted), -1)
    at = np.minimum(np.searchsorted(sorted_keys, wanted), len(sorted_keys) - 1)
    return np.where(sorted_keys[at] == wanted, at, -1)


def _gram_places(offsets: np.ndarray, words: np.ndarray, keys: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions at which a known n-gram begins, and its place among the keys."""
    grams = _grams(words, size)
    inside = _starts_inside(offsets, size)[:len(grams)]
    place = np.where(inside, _places(keys, grams), -1)
    at = np.flatnonzero(place >= 0)
    return at, place[at]


# ---- items ------------------------------------------------------------------

def _item_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        offsets, words = _word_hashes(batch.column("text"))
        yield pa.RecordBatch.from_arrays(
            [batch.column("item_id"), pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(words.view(np.int64)))],
            names=["item_id", "words"])


def distinct_items(items: DataFrame) -> DataFrame:
    """One row per distinct sequence of words: smallest ``item_id`` and ``words`` (hashes)."""
    rows = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    return (rows.mapInArrow(on_workers(__name__, "_item_batches"), "item_id long, words array<long>")
            .where((F.size("words") >= SEED_WORDS) & F.col("item_id").isNotNull())
            .groupBy("words").agg(F.min("item_id").alias("item_id")))


def _item_arrays(rows: pa.Table) -> dict:
    """The items of one block, and their n-grams, sorted by hash, as seeds with their places."""
    lists = rows.column("words").combine_chunks()
    offsets = lists.offsets.to_numpy().astype(np.int64)
    words = lists.values.to_numpy().view(np.uint64)[offsets[0]:offsets[-1]]
    offsets = offsets - offsets[0]
    inside = np.flatnonzero(_starts_inside(offsets, SEED_WORDS)) if len(words) else np.zeros(0, np.int64)
    item = np.searchsorted(offsets, inside, side="right") - 1
    keys, place = np.unique(_grams(words, SEED_WORDS)[inside], return_inverse=True)
    place = place.reshape(-1)
    order = np.argsort(place, kind="stable")
    upto = np.concatenate([[0], np.cumsum(np.bincount(place, minlength=len(keys)))])
    return {"ids": rows.column("item_id").to_numpy(), "offsets": offsets, "words": words,
            "keys": keys, "seed_upto": upto, "seed_item": item[order], "seed_at": (inside - offsets[item])[order]}


# ---- documents --------------------------------------------------------------

def align(items: list[np.ndarray], passages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best Smith-Waterman score of each item against its passage, and the
    passage words [start, end) that the best alignment covers.

    Equal words score MATCH, others MISMATCH, a word left out GAP. Pairs are
    aligned side by side, one item word at a time over all passage words. Of
    equal scores the first end is taken.
    """
    pairs = len(items)
    rows, columns = max(map(len, items)), max(map(len, passages))
    item = np.zeros((pairs, rows), np.uint64)
    passage = np.zeros((pairs, columns), np.uint64)
    for i in range(pairs):
        item[i, :len(items[i])] = items[i]
        passage[i, :len(passages[i])] = passages[i]
    item_length, length = np.array([*map(len, items)]), np.array([*map(len, passages)])
    outside = np.arange(columns) >= length[:, None]
    best, end, start = np.zeros(pairs, np.int64), np.zeros(pairs, np.int64), np.zeros(pairs, np.int64)
    # A cell packs its score and where its alignment began, so that one maximum
    # keeps both; of equal scores the later beginning wins.
    wide = columns + 1
    step = np.arange(columns + 1) * (-GAP * wide)
    before = np.broadcast_to(np.arange(columns + 1), (pairs, columns + 1)).copy()
    fresh = np.arange(columns + 1)
    for r in range(rows):
        same = (item[:, r, None] == passage) & ~outside
        here = np.empty_like(before)
        here[:, 0] = 0
        here[:, 1:] = np.maximum(before[:, :-1] + np.where(same, MATCH, MISMATCH) * wide, before[:, 1:] + GAP * wide)
        np.maximum(here, fresh, out=here)
        here = np.maximum.accumulate(here + step, axis=1) - step
        np.maximum(here, fresh, out=here)
        inside = here[:, 1:] // wide
        inside[outside] = 0
        top = inside.argmax(1)
        value = inside[np.arange(pairs), top]
        better = (value > best) & (r < item_length)
        best[better], end[better] = value[better], top[better] + 1
        start[better] = here[np.arange(pairs), top + 1][better] % wide
        before = here
    return best, start, end


def _passages(block: dict, offsets: np.ndarray, words: np.ndarray, min_score: float) -> tuple[np.ndarray, ...]:
    """(document, item, first word, end word) of every passage to align."""
    at, place = _gram_places(offsets, words, block["keys"], SEED_WORDS)
    times = np.diff(block["seed_upto"])[place]
    hit = np.repeat(np.arange(len(at)), times)
    nth = np.arange(len(hit)) - np.repeat(np.cumsum(times) - times, times)
    seed = block["seed_upto"][place[hit]] + nth
    item, begin = block["seed_item"][seed], at[hit] - block["seed_at"][seed]
    rare = times[hit] <= RARE_ITEMS
    doc = np.searchsorted(offsets, at[hit], side="right") - 1
    if not len(hit):
        return (np.zeros(0, np.int64),) * 4
    # Hits that place the item at about the same word are one passage.
    order = np.lexsort((begin, item, doc))
    doc, item, begin, rare = doc[order], item[order], begin[order], rare[order]
    length = np.diff(block["offsets"])[item]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (item[1:] != item[:-1]) | (begin[1:] - begin[:-1] > length[1:])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(doc)) - 1
    # One rare seed, or two. An item that has no other seed counts with what it has.
    seeds = np.maximum(1, length[first] - SEED_WORDS + 1)
    told = np.logical_or.reduceat(rare, first) | (last - first + 1 >= np.minimum(2, seeds))
    first, last = first[told], last[told]
    slack = length[first] // 2 + SEED_WORDS
    doc, item, length = doc[first], item[first], length[first]
    low = np.maximum(begin[first] - slack, offsets[doc])
    high = np.minimum(begin[last] + length + slack, offsets[doc + 1])
    enough = np.zeros(len(doc), bool)
    edges = np.concatenate([[0], np.flatnonzero(np.diff(np.cumsum(high - low + length) // CHECKED)) + 1, [len(doc)]])
    for a, z in zip(edges[:-1], edges[1:]):
        enough[a:z] = _shared(block, words, item[a:z], low[a:z], high[a:z]) >= min_score * length[a:z]
    return doc[enough], item[enough], low[enough], high[enough]


def _flat(starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every place of the runs that begin at ``starts``, and each place's run."""
    run = np.repeat(np.arange(len(starts)), lengths)
    return np.arange(len(run)) - np.repeat(np.cumsum(lengths) - lengths, lengths) + starts[run], run


def _shared(block: dict, words: np.ndarray, item: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """How many words of each item its passage holds at all. An alignment matches no more."""
    if not len(item):
        return np.zeros(0, np.int64)
    with np.errstate(over="ignore"):
        at, run = _flat(low, high - low)
        held = np.unique(words[at] ^ (run.astype(np.uint64) * _P))
        at, run = _flat(block["offsets"][item], np.diff(block["offsets"])[item])
        there = _places(held, block["words"][at] ^ (run.astype(np.uint64) * _P)) >= 0
    return np.bincount(run, weights=there, minlength=len(item))


def _align_batches(batches: Iterator[pa.RecordBatch], shared, min_score: float) -> Iterator[pa.RecordBatch]:
    block = shared.value
    item_words = np.split(block["words"], block["offsets"][1:-1]) if len(block["ids"]) else []
    for batch in batches:
        for part in slices(batch, "text", SLICE):
            offsets, words = _word_hashes(part.column("text"))
            doc, item, low, high = _passages(block, offsets, words, min_score)
            score, start, end = np.zeros(len(doc)), np.zeros(len(doc), np.int64), np.zeros(len(doc), np.int64)
            order = np.argsort(high - low, kind="stable")
            # The shorter passages of a group are padded to its longest one.
            groups = []
            for i in order.tolist():
                if not groups or (len(groups[-1]) + 1) * (high[i] - low[i]) > CELLS:
                    groups.append([])
                groups[-1].append(i)
            for group in groups:
                best, a, z = align([item_words[item[j]] for j in group], [words[low[j]:high[j]] for j in group])
                score[group] = best / np.array([MATCH * len(item_words[item[j]]) for j in group])
                start[group], end[group] = low[group] + a - offsets[doc[group]], low[group] + z - offsets[doc[group]]
            kept = np.flatnonzero(score >= min_score)
            # The best passage of each document and item; of equal ones the first.
            kept = kept[np.lexsort((start[kept], -score[kept], item[kept], doc[kept]))]
            one = np.ones(len(kept), bool)
            one[1:] = (doc[kept][1:] != doc[kept][:-1]) | (item[kept][1:] != item[kept][:-1])
            kept = kept[one]
            rows = pa.array(doc[kept])
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id").take(rows), part.column("text_key").take(rows), pa.array(block["ids"][item[kept]]),
                 pa.array(score[kept]), pa.array(start[kept]), pa.array(end[kept])],
                names=["doc_id", "text_key", "item_id", "score", "start_word", "end_word"])


def contaminated(docs: DataFrame, items: DataFrame, min_score: float = MIN_SCORE, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Passages of ``docs`` (``doc_id``, ``text``) that copy an item of ``items`` (``item_id``, ``text``).

    One row per document and item whose best alignment scores at least
    ``min_score`` of the item's full score: ``doc_id``, ``text_key``,
    ``item_id``, ``score`` (0 to 1), ``start_word`` and ``end_word`` (words of
    the document, end exclusive). Words are runs of letters and digits in lower
    case. Items with the same words are one, under their smallest item_id;
    items of fewer than SEED_WORDS words have no seed and match nothing, nor do
    items without an id. Null and empty texts match nothing; repeated documents
    each get their rows; texts are read whole; other columns are not read.
    Either table may be empty.

    What a block of items broadcasts is bounded by ``block_words``. One pass
    over the texts per block, without a shuffle of texts or of matches: a
    passage that very many documents hold is aligned where each of them lies.
    A copy is found if it shares SEED_WORDS words in a row with its item that at most
    RARE_ITEMS items of the block hold, or two such runs that more hold.
    """
    spark = docs.sparkSession
    distinct = stored(distinct_items(items), "items")
    total = distinct.agg(F.sum(F.size("words"))).first()[0] or 0
    blocks = -(-total // block_words) or 1
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    keyed = rows.withColumn("text_key", text_key(F.col("text")))
    found = None
    for b in range(blocks):
        block = _item_arrays(distinct.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == b).orderBy("item_id").toArrow())
        if not len(block["ids"]) and blocks > 1:
            continue
        shared = spark.sparkContext.broadcast(block)
        part = keyed.mapInArrow(on_workers(__name__, "_align_batches", shared, min_score),
                                "doc_id long, text_key long, item_id long, score double, start_word long, end_word long")
        found = part if found is None else found.unionByName(part)
    return found


def without_contaminated(docs: DataFrame, items: DataFrame, min_score: float = MIN_SCORE) -> DataFrame:
    """The rows of ``docs`` that copy no item, with their own columns."""
    return rows_without(docs, contaminated(docs, items, min_score))
