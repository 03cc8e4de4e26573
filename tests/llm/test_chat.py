"""Perspective rotation against a plain rendering of each dialogue."""

from __future__ import annotations

import random

from carebook.llm import chat


def rendered(rows):
    """{(conv, perspective): (whole text, learned spans)}"""
    out = {}
    for conv in {r[0] for r in rows}:
        turns = sorted(((r[1] is not None, r[1] or 0), r[2] or "unnamed", r[3] or "") for r in rows if r[0] == conv)
        for who in {s for _, s, _ in turns} - {"system"}:
            def head(s):
                return "<|system|>\n" if s == "system" else "<|assistant|>\n" if s == who else f"<|user|>{s}\n"
            parts = sorted((t, s, head(s) + text + "<|end|>\n", len(head(s))) for t, s, text in turns)
            whole, learn = "", []
            for _, s, segment, h in parts:
                if s == who:
                    learn.append((len(whole) + h, len(whole) + len(segment)))
                whole += segment
            out[conv, who] = (whole, learn)
    return out


def test_rotation(spark):
    rnd = random.Random(8)
    rows = [(c, t, rnd.choice(["user", "assistant", "ann", "bob", "system", None]), rnd.choice(["hi", "ä\n日本 😀", None, "", "<|end|>"]))
            for c in range(20) for t in range(rnd.randint(1, 9))]
    rows += [(100, t, rnd.choice(["ann", "bob", "cid"]), f"turn {t}") for t in range(700)]        # a third of all rows
    rows += [(101, 0, "ann", "same")] * 4 + [(101, 0, "bob", "tie"), (102, None, "ann", "no turn"), (102, 1, "ann", "x"), (103, 0, "system", "alone")]
    rows += [(None, 0, "ann", "no id"), (None, 1, "bob", "no id")]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr(
        "*", "1 AS position", "2 AS part", "3 AS segment", "4 AS speaker", "5 AS perspective", "6 AS length")
    got = {}
    for r in chat.rotate(frame.repartition(5)).collect():
        got.setdefault((r.conv_id, r.perspective), []).append(r)
    want = rendered(rows)
    assert got.keys() == want.keys()
    for key, segments in got.items():
        segments.sort(key=lambda r: r.position)
        whole = "".join(r.segment for r in segments)
        assert [r.position for r in segments] == list(range(len(segments)))
        assert (whole, [(r.train_start, r.train_end) for r in segments if r.train_start is not None]) == want[key]
        assert all(whole[r.start:r.end] == r.segment for r in segments)
    assert chat.rotate(frame.where("false")).count() == 0


def test_many_ties_over_several_partitions(spark):
    rows = [(1, None, "ann", f"tie {i * 7919 % 4001}") for i in range(4001)] + [(2, t, "bob", "x") for t in range(50)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)
    kept = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        for partitions in ("3", "16"):
            spark.conf.set("spark.sql.shuffle.partitions", partitions)
            spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
            got = [r.segment for r in chat.rotate(frame).where("conv_id = 1").orderBy("position").collect()]
            assert got == sorted(got) and len(got) == 4001
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)


def test_equal_beginnings_are_spread(spark):
    """A third of all rows tie in turn, speaker and their first 2,000 characters, or are the same throughout."""
    rows = [(1, None, "ann", "x" * 2000 + (str(i) if i % 2 else "")) for i in range(1000)] + [(2, t, "bob", "y") for t in range(300)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)
    kept = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    real, parts = chat.stored, []
    try:
        chat.stored = lambda df, purpose: parts.append(real(df, purpose)) or parts[-1]
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        got = chat.rotate(frame).where("conv_id = 1").collect()
        assert sorted(r.position for r in got) == list(range(1000)) and sum(len(r.segment) for r in got) == max(r.end for r in got)
        sizes = [r["count"] for r in parts[0].groupBy("part").count().collect()]
        assert len(sizes) >= 6 and max(sizes) < 400
    finally:
        chat.stored = real
        for k, v in kept.items():
            spark.conf.set(k, v)
