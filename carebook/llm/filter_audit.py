"""Filter interaction audit by a Gray-code subset walk.

Five filters give every document a mask of the filters that it fails; documents
with one mask are one cell. The walk visits all 32 sets of active filters in
Gray-code order, so each step toggles one filter: a counter in each cell says
how many active filters it fails, and a cell whose counter leaves or reaches
zero is taken from or given back to the running survivors. The survivors of the
32 sets are stored; what a filter removes at a place of any order is the
difference of two of them.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from carebook.llm.common import on_workers, stored

FILTERS = "ABCDE"
STATES = 2 ** len(FILTERS)
MIN_WORDS = 200
MIN_DISTINCT_PERCENT = 50
MAX_CAPITALS_PERCENT = 2
SYMBOLS = "[#$%&*|]"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
COUNTS = ("n", "good", "toxic")

_STATE_SCHEMA = "part string, state int, n long, good long, toxic long"


def _bit(filter_: str) -> int:
    return 1 << FILTERS.index(filter_)


def own_failures(text: Column, words: Column) -> Column:
    """Mask of the filters A to D that a text fails, read off the text and its words."""
    fails = {
        "A": F.size(words) < MIN_WORDS,
        "B": 100 * F.size(F.array_distinct(words)) < MIN_DISTINCT_PERCENT * F.size(words),
        "C": 100 * (F.length(text) - F.length(F.translate(text, CAPITALS, ""))).cast("long") > MAX_CAPITALS_PERCENT * F.length(text).cast("long"),
        "D": text.rlike(SYMBOLS),
    }
    mask = F.lit(0)
    for name, failed in fails.items():
        mask = mask + F.when(failed, _bit(name)).otherwise(0)
    return mask.cast("int")


def failure_cells(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, n, good, toxic): documents of each part and failure mask, and how
    many of them are labelled of good quality and toxic.

    Texts stay where they are read: only a document's key, mask and SHA-256 go on.
    The first document of a text is found by a minimum per digest, which every task
    takes before the shuffle, and joined by digest and doc_id, so a text that a
    third of the rows share is no hot key.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    words = F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")
    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"),
                       text.alias("text"), words.alias("words"))
    rows = stored(read.select("doc_id", "part", own_failures(F.col("text"), F.col("words")).alias("mask"),
                              F.unhex(F.sha2(F.col("text"), 256)).alias("digest")), "failures")
    firsts = rows.where(F.col("doc_id").isNotNull()).groupBy("digest").agg(F.min("doc_id").alias("first"))
    firsts = firsts.select(F.col("digest").alias("_digest"), F.col("first").alias("_first"))
    labelled = (labels.select(F.col("doc_id").cast("long").alias("_labelled"), (F.col("quality") == 1).alias("good"), (F.col("toxic") == 1).alias("toxic"))
                .where("good OR toxic").groupBy("_labelled").agg(F.max("good").alias("good"), F.max("toxic").alias("toxic")))
    later = F.col("doc_id").isNotNull() & F.col("_first").isNull()
    joined = (rows.join(labelled, F.col("doc_id") == F.col("_labelled"), "left")
              .join(firsts, (F.col("digest") == F.col("_digest")) & (F.col("doc_id") == F.col("_first")), "left")
              .withColumn("mask", F.col("mask") + F.when(later, _bit("E")).otherwise(0)))
    return joined.groupBy("part", "mask").agg(F.count(F.lit(1)).alias("n"), F.count_if("good").alias("good"), F.count_if("toxic").alias("toxic"))


def walk(cells: np.ndarray) -> np.ndarray:
    """Survivors of every set of active filters: ``cells`` (parts, 32 masks, counts) to
    (32 states, parts, counts). One filter is toggled at each step."""
    masks = np.arange(STATES)
    failing = np.zeros(STATES, np.int64)  # active filters that a cell fails
    alive = cells.sum(1)
    out = np.empty((STATES, *alive.shape), np.int64)
    out[0] = alive
    state = 0
    for step in range(1, STATES):
        place = (step & -step).bit_length() - 1
        state ^= 1 << place
        fails = masks >> place & 1 == 1
        if state >> place & 1:
            moved = fails & (failing == 0)
            failing[fails] += 1
            alive = alive - cells[:, moved].sum(1)
        else:
            failing[fails] -= 1
            moved = fails & (failing == 0)
            alive = alive + cells[:, moved].sum(1)
        out[state] = alive
    return out


def _walk_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        parts = batch.num_rows
        lists = batch.column("cells")
        whose = np.repeat(np.arange(parts), np.diff(lists.offsets.to_numpy()))
        values = lists.flatten()
        cells = np.zeros((parts, STATES, len(COUNTS)), np.int64)
        masks = values.field("mask").to_numpy()
        for i, name in enumerate(COUNTS):
            cells[whose, masks, i] = values.field(name).to_numpy()
        states = walk(cells).transpose(1, 0, 2).reshape(parts * STATES, len(COUNTS))
        yield pa.RecordBatch.from_arrays(
            [batch.column("part").take(pa.array(np.repeat(np.arange(parts), STATES))), pa.array(np.tile(np.arange(STATES, dtype=np.int32), parts)),
             *[pa.array(np.ascontiguousarray(states[:, i])) for i in range(len(COUNTS))]],
            names=["part", "state", *COUNTS])


def survivors(cells: DataFrame) -> DataFrame:
    """(part, state, n, good, toxic): what every set of active filters leaves of each part.

    ``state`` has bit i set if filter i is active. A part has 32 cells at most.
    """
    gathered = cells.groupBy("part").agg(F.collect_list(F.struct("mask", *COUNTS)).alias("cells"))
    return gathered.mapInArrow(on_workers(__name__, "_walk_batches"), _STATE_SCHEMA)


def _steps() -> Column:
    """Every step of every order, as a constant array."""
    rows = []
    for order in permutations(FILTERS):
        active = 0
        for i, name in enumerate(order):
            rows.append({"filter_order": "".join(order), "step": i + 1, "filter": name, "before": active,
                         "after": active | _bit(name), "alone": _bit(name)})
            active |= _bit(name)
    kind = "array<struct<filter_order: string, step: int, filter: string, before: int, after: int, alone: int>>"
    return F.from_json(F.lit(json.dumps(rows)), kind)


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """What each filter removes at each place of each order of the five, in every part.

    ``docs`` has ``doc_id``, ``text`` and ``source``, ``labels`` has ``doc_id``,
    ``quality`` and ``toxic``; other columns are not read. One row per ``part`` (a
    source), ``filter_order`` (120) and ``step`` (1 to 5), with ``filter`` (the
    step's) and the counts of documents: ``kept`` after the step, ``removed`` by it,
    ``redundant`` (fail its filter but were gone before), ``unique_fails`` (fail its
    filter alone), ``good_lost`` and ``toxic_lost`` (removed here, labelled so), and
    ``shapley``, the filter's removals summed over all orders.

    A null source is the part of the empty one, a null text is empty. A document with
    a null doc_id has no smaller doc_id and no label; rows that repeat a doc_id are
    documents each, and none of them is later than the other. A document labelled
    more than once has each label that a row gives it; labels of unknown documents
    count nothing. Texts are identical if their SHA-256 is. An empty table has no
    part and gives no rows.
    """
    states = stored(survivors(failure_cells(docs, labels)), "filter-states")
    at = F.array_sort(F.collect_list(F.struct("state", *COUNTS)))
    parts = states.groupBy("part").agg(at.alias("at")).select("part", "at", F.explode(_steps()).alias("s"))

    def left(state: Column | int, count: str = "n") -> Column:
        return F.col("at")[state][count]

    before, after, alone = F.col("s.before"), F.col("s.after"), F.col("s.alone")
    every = STATES - 1
    removed = left(before) - left(after)
    rows = parts.select(
        "part", "s.filter_order", "s.step", "s.filter", left(after).alias("kept"), removed.alias("removed"),
        (left(0) - left(alone) - removed).alias("redundant"), (left(F.lit(every) - alone) - left(every)).alias("unique_fails"),
        (left(before, "good") - left(after, "good")).alias("good_lost"), (left(before, "toxic") - left(after, "toxic")).alias("toxic_lost"))
    return rows.withColumn("shapley", F.sum("removed").over(Window.partitionBy("part", "filter")))


ORACLE = r"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents),
w AS (
  SELECT *, list_filter(string_split_regex(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws,
         doc_id > min(doc_id) OVER (PARTITION BY t) AS later
  FROM d
),
m AS (
  SELECT doc_id, part,
         CASE WHEN len(ws) < 200 THEN 1 ELSE 0 END
         + CASE WHEN 100 * len(list_distinct(ws)) < 50 * len(ws) THEN 2 ELSE 0 END
         + CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * length(t) THEN 4 ELSE 0 END
         + CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END
         + CASE WHEN later THEN 16 ELSE 0 END AS mask
  FROM w
),
g AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
cells AS (
  SELECT part, mask, count(*) AS n, count(*) FILTER (WHERE good) AS good, count(*) FILTER (WHERE toxic) AS toxic
  FROM m LEFT JOIN g USING (doc_id) GROUP BY part, mask
),
f AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f, unnest([1, 2, 4, 8, 16]) AS bit),
orders AS (
  SELECT a.f || b.f || c.f || d.f || e.f AS filter_order FROM f a, f b, f c, f d, f e
  WHERE a.f NOT IN (b.f, c.f, d.f, e.f) AND b.f NOT IN (c.f, d.f, e.f) AND c.f NOT IN (d.f, e.f) AND d.f <> e.f
),
steps AS (
  SELECT filter_order, i AS step, f, bit,
         (SELECT coalesce(sum(p.bit), 0) FROM f p WHERE instr(filter_order, p.f) < i)::INTEGER AS before
  FROM orders, range(1, 6) r(i), f WHERE f.f = substr(filter_order, i, 1)
),
counted AS (
  SELECT part, filter_order, step, f, bit,
         coalesce(sum(n) FILTER (WHERE mask & (before | bit) = 0), 0) AS kept,
         coalesce(sum(n) FILTER (WHERE mask & before = 0 AND mask & bit > 0), 0) AS removed,
         coalesce(sum(n) FILTER (WHERE mask & before > 0 AND mask & bit > 0), 0) AS redundant,
         coalesce(sum(n) FILTER (WHERE mask = bit), 0) AS unique_fails,
         coalesce(sum(good) FILTER (WHERE mask & before = 0 AND mask & bit > 0), 0) AS good_lost,
         coalesce(sum(toxic) FILTER (WHERE mask & before = 0 AND mask & bit > 0), 0) AS toxic_lost
  FROM cells, steps GROUP BY ALL
)
SELECT part, filter_order, step::INTEGER AS step, f AS filter, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant,
       unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
       (sum(removed) OVER (PARTITION BY part, f))::BIGINT AS shapley
FROM counted
"""
