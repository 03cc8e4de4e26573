"""The bit-sliced index against plain inner products."""

from __future__ import annotations

import math

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from carebook.llm import bit_sliced as bs


def block(values):
    n = len(values)
    lows, counts, slices = bs._slices(values)
    ids = np.arange(n)
    return bs.Block(n, ids.tobytes(), ids.tobytes(), lows.tobytes(), counts.tobytes(), slices.tobytes())


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 150), st.integers(1, 6), st.integers(0, 2 ** 31), st.sampled_from([1, 2, 64, 5000]), st.integers(1, 25))
def test_block_top_equals_sorting(rows, dim, seed, size, k):
    rng = np.random.default_rng(seed)
    values = rng.integers(-size, size, (rows, dim)) // (1 + rng.integers(0, 2, dim) * size)
    b = block(values)
    for _ in range(3):
        weights = rng.integers(-size, size + 1, dim)
        own = int(rng.integers(0, rows + 2))
        scores = values @ weights
        order = [r for r in np.lexsort((np.arange(rows), -scores)) if r != own][:k]
        got, found = b.top(weights, own, k)
        assert sorted(zip(got.tolist(), found.tolist())) == sorted((r, int(scores[r])) for r in order)


def brute(rows, every=20, k=20):
    fine = [(i, [math.floor(64 * x) for x in v]) for i, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for a, (i, q) in enumerate(fine):
        if i is None or i % every:
            continue
        scored = sorted((-sum(x * y for x, y in zip(q, v)), j is None, j or 0) for b, (j, v) in enumerate(fine) if b != a and len(v) == len(q))[:k]
        out += [(i, r + 1, -1 if missing else j, -s) for r, (s, missing, j) in enumerate(scored)]
    return sorted(out)


def test_top_k(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.normal(0, 0.2, 8)]) for i in range(300)]
    rows += [(i, [0.5] * 8) for i in range(300, 420)]                       # a very common vector
    rows += [(20, [0.1] * 8), (40, rows[40][1]), (None, [0.9] * 8), (None, [0.5] * 8)]  # repeated and null ids
    rows += [(460, None), (480, [1.0, None] * 4), (500, [float("nan")] * 8), (520, [float("inf")] * 8), (540, [3e5] * 8), (541, [-3e5, 3e5] * 4)]
    rows += [(560, [0.25, 0.5]), (561, [1.0, 1.0]), (580, []), (581, [])]   # other lengths
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr(
        "*", "1 AS uid", "2 AS q", "3 AS shard", "4 AS dim", "5 AS score", "6 AS `rank`")
    for block_rows in (bs.BLOCK_ROWS, 100):
        got = bs.top_k(frame.repartition(4), block_rows=block_rows).collect()
        assert sorted((r.query_id, r.rank, -1 if r.vec_id is None else r.vec_id, r.score) for r in got) == brute(rows)
    assert bs.top_k(frame.where("false")).count() == 0
    con = duckdb.connect()
    con.execute("CREATE TABLE embeddings (vec_id BIGINT, embedding DOUBLE[])")
    con.executemany("INSERT INTO embeddings VALUES (?, ?)", rows)
    assert sorted((q, r, -1 if v is None else v, s) for q, r, v, s in con.execute(bs.ORACLE).fetchall()) == brute(rows)


def test_products_beyond_a_long_raise(spark):
    for big in (1e30, 1e8):
        rows = [(i, [big] * 8) for i in (0, 1)]
        with pytest.raises(ValueError):
            bs.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
