"""Chat formatting by perspective rotation.

Each dialogue is rendered once for every participant: that speaker's turns are
the assistant's, the others' are users' under their names, and only the
assistant's words are to be learned. The rendering of a dialogue is the
concatenation of its segments, one row per turn, with each segment's place in
it; so a dialogue of any length is never one value or one task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from carebook.llm.common import on_workers, stored
from carebook.operators.broadcast import bounded_broadcast

CONTEXT_ROLES = ("system",)  # rendered for everyone, nobody's perspective
UNNAMED = "unnamed"
END = "<|end|>\n"
MAX_SPANNING = 1_000_000
RANGE_CHARS = 1024


def _head(speaker: Column, perspective: Column) -> Column:
    return (F.when(speaker.isin(*CONTEXT_ROLES), F.concat(F.lit("<|"), speaker, F.lit("|>\n")))
            .when(speaker == perspective, F.lit("<|assistant|>\n"))
            .otherwise(F.concat(F.lit("<|user|>"), speaker, F.lit("\n"))))


def _running_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Position and characters before each segment, within this partition's part of its dialogue."""
    from pyspark import TaskContext
    part, key, position, done = TaskContext.get().partitionId(), None, 0, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.empty(batch.num_rows, object)
        keys[:] = list(zip(batch.column("conv_id").to_pylist(), batch.column("perspective").to_pylist()))
        lengths = batch.column("length").to_numpy()
        new = np.ones(len(keys), bool)
        new[0] = keys[0] != key
        new[1:] = keys[1:] != keys[:-1]
        first = np.flatnonzero(new)
        lead = first[0] if len(first) else len(keys)  # rows that go on with the last batch's dialogue
        rows = np.arange(len(keys))
        run = np.cumsum(new) - 1
        before = np.cumsum(lengths) - lengths
        at = np.where(rows < lead, rows + position, rows - first[np.maximum(run, 0)] if len(first) else 0)
        start = np.where(rows < lead, before + done, before - before[first[np.maximum(run, 0)]] if len(first) else 0)
        key, position, done = keys[-1], int(at[-1]) + 1, int(start[-1] + lengths[-1])
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(np.full(len(keys), part, np.int32)), pa.array(at), pa.array(start)],
            names=[*batch.schema.names, "part", "local_position", "local_start"])


def rotate(turns: DataFrame) -> DataFrame:
    """Segments of every dialogue from every participant's perspective.

    ``turns`` has ``conv_id``, ``turn``, ``role`` (the speaker's name) and
    ``text``; other columns are not read. Returns ``conv_id``, ``perspective``,
    ``position`` (from 0), ``turn``, ``speaker``, ``segment``, ``start`` and
    ``end`` (its characters in the rendered dialogue, end exclusive) and
    ``train_start`` and ``train_end`` (the characters to learn: the text and end
    mark of the assistant's turns; both null for others).

    Turns are ordered by ``turn``, then speaker, then segment; segments that tie in
    all these and in their first RANGE_CHARS characters go by a hash of the whole.
    So ties and repeated rows have a fixed place and are all rendered. A null role is ``unnamed``, a
    null text is empty, a null turn comes first; rows with a null conv_id form
    one dialogue. CONTEXT_ROLES take part but are no perspective; a dialogue of
    these alone has none and gives no rows, nor does an empty table.

    Dialogues are sorted over range partitions, so one that holds much of the
    table lies in many; sums are carried from part to part.
    """
    rows = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                        F.coalesce(F.col("role").cast("string"), F.lit(UNNAMED)).alias("speaker"),
                        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), F.monotonically_increasing_id().alias("_row"))
    people = rows.where(~F.col("speaker").isin(*CONTEXT_ROLES)).select(
        F.col("conv_id").alias("_conv"), F.col("speaker").alias("perspective")).distinct()
    seen = rows.join(people, F.col("conv_id").eqNullSafe(F.col("_conv"))).drop("_conv")
    head = _head(F.col("speaker"), F.col("perspective"))
    seen = seen.select("conv_id", "perspective", "turn", "speaker", F.length(head).cast("long").alias("head_length"),
                       F.concat(head, "text", F.lit(END)).alias("segment"), "_row").withColumn("length", F.length("segment").cast("long"))
    seen = seen.withColumns({"_begins": F.substring("segment", 1, RANGE_CHARS), "_hash": F.xxhash64("segment")})
    order = ["conv_id", "perspective", "turn", "speaker", "_begins", "_hash", "_row"]
    schema = ("conv_id long, perspective string, turn long, speaker string, head_length long, segment string, length long, "
              "part int, local_position long, local_start long")
    # The driver samples what ranges are cut by, so that is a segment's beginning and
    # a hash; the row's number cuts rows that are the same throughout.
    parts = stored(seen.repartitionByRange(*order).sortWithinPartitions(*order).drop("_begins", "_hash", "_row")
                   .mapInArrow(on_workers(__name__, "_running_batches"), schema), "turns")
    sums = parts.groupBy("conv_id", "perspective", "part").agg(F.count(F.lit(1)).alias("_rows"), F.sum("length").alias("_chars"))
    dialogue = Window.partitionBy("conv_id", "perspective").orderBy("part")
    earlier = dialogue.rowsBetween(Window.unboundedPreceding, -1)
    # Only dialogues cut by a partition's edge carry anything: two parts an edge at most.
    carried = (sums.withColumn("_rows_before", F.sum("_rows").over(earlier)).withColumn("_chars_before", F.sum("_chars").over(earlier))
               .where(F.col("_rows_before").isNotNull())
               .select(F.col("conv_id").alias("_conv"), F.col("perspective").alias("_who"), F.col("part").alias("_part"),
                       "_rows_before", "_chars_before"))
    same = F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("perspective") == F.col("_who")) & (F.col("part") == F.col("_part"))
    start = F.col("local_start") + F.coalesce("_chars_before", F.lit(0))
    own = F.col("speaker") == F.col("perspective")
    return (parts.join(bounded_broadcast(carried, MAX_SPANNING), same, "left")
            .select("conv_id", "perspective", (F.col("local_position") + F.coalesce("_rows_before", F.lit(0))).alias("position"),
                    "turn", "speaker", "segment", start.alias("start"), (start + F.col("length")).alias("end"),
                    F.when(own, start + F.col("head_length")).alias("train_start"),
                    F.when(own, start + F.col("length")).alias("train_end")))


ORACLE = """
WITH t AS (
  SELECT conv_id, turn, coalesce(role, 'unnamed') AS speaker, coalesce(text, '') AS text FROM conversations
),
p AS (SELECT DISTINCT conv_id, speaker AS perspective FROM t WHERE speaker <> 'system'),
s AS (
  SELECT t.conv_id, perspective, turn, speaker, text,
         CASE WHEN speaker = 'system' THEN '<|system|>' || chr(10) WHEN speaker = perspective THEN '<|assistant|>' || chr(10)
              ELSE '<|user|>' || speaker || chr(10) END AS head
  FROM t JOIN p ON t.conv_id IS NOT DISTINCT FROM p.conv_id
),
g AS (SELECT *, head || text || '<|end|>' || chr(10) AS segment FROM s),
w AS (
  SELECT *, row_number() OVER o - 1 AS position,
         (sum(length(segment)) OVER (o ROWS UNBOUNDED PRECEDING))::BIGINT AS "end"
  FROM g WINDOW o AS (PARTITION BY conv_id, perspective ORDER BY turn NULLS FIRST, speaker, segment)
)
SELECT conv_id, perspective, position, turn, speaker, segment, "end" - length(segment) AS start, "end",
       CASE WHEN speaker = perspective THEN "end" - length(segment) + length(head) END AS train_start,
       CASE WHEN speaker = perspective THEN "end" END AS train_end
FROM w
"""
