"""Multi-index hashing against all distances, and recall against exact search."""

from __future__ import annotations

import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from carebook.llm import hamming_search as hs
from carebook.llm.common import table
from tests.conftest import CHECK_DIR
from tests.llm.data import CLASHING


def block(codes, vectors=None):
    n = len(codes)
    return hs.Block(codes, np.ones((n, 2)) if vectors is None else vectors, np.arange(n), np.arange(n))


@settings(max_examples=40, deadline=None)
@given(st.integers(1, 120), st.sampled_from([64, 128, 256]), st.integers(0, 2 ** 31), st.integers(1, 40))
def test_radius_holds_every_code(rows, bits, seed, wanted):
    """All codes up to the distance of the wanted-th, ties included, and no other."""
    rng = np.random.default_rng(seed)
    codes = rng.integers(0, 256, (rows, bits // 8), np.uint8)
    codes[: rows // 3] = codes[0]  # a group of copies
    flips = rng.random((rows, bits)) < rng.random((rows, 1)) * 0.5
    codes[rows // 2:] = codes[0] ^ np.packbits(flips, axis=1)[rows // 2:]
    for query in (codes[0], rng.integers(0, 256, bits // 8).astype(np.uint8)):
        distances = np.bitwise_count(codes ^ query).sum(1, dtype=np.int64)
        radius = np.sort(distances)[min(wanted, rows) - 1]
        assert sorted(block(codes).within(query, wanted).tolist()) == np.flatnonzero(distances <= radius).tolist()


def brute(rows, every, k):
    fine = [(i, v) for i, v in rows if v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    out = []
    for a, (i, q) in enumerate(fine):
        if i is None or i % every:
            continue
        unit = [np.array(x) / max(map(abs, x)) for _, x in fine]
        others = [(np.dot(unit[a], unit[b]) / (np.linalg.norm(unit[a]) * np.linalg.norm(unit[b])), j) for b, (j, v) in enumerate(fine) if b != a and len(v) == len(q)]
        others.sort(key=lambda x: (-round(x[0], 12), x[1] is None, x[1]))
        out += [(i, rank, j, s) for rank, (s, j) in enumerate(others[:k], 1)]
    return out


def frame(spark, rows):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    return df.select("*", *[F.lit(i).alias(c) for i, c in enumerate((*CLASHING, "uid", "v", "dim", "code", "shard", "share", "query"))])


def same(found, expected):
    assert [r[:3] for r in found] == [r[:3] for r in expected]
    assert all(abs(a[3] - b[3]) < 1e-12 for a, b in zip(found, expected))


def test_odd_rows(spark):
    """With few rows all codes lie within the radius, so the result is exact: nulls, ties, repeated rows, lengths."""
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=6).tolist()) for i in range(40)]
    rows += [(100 + i, rows[5][1]) for i in range(8)] + [(5, rows[5][1]), (None, rows[10][1])]  # ties, a repeated row, a null id
    rows += [(200, None), (210, []), (220, [0.0] * 6), (230, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (240, [math.nan] * 6), (250, [math.inf] + [1.0] * 5)]
    rows += [(300, [1e200, 1e190]), (301, [2e200, 0.0]), (310, [1.0, 1.0]), (400, [3.0]), (410, [-3.0]), (420, [5.0])]
    found = sorted(map(tuple, hs.nearest(frame(spark, rows), every=10, k=4).collect()))
    same(found, sorted(brute(rows, 10, 4), key=lambda r: r[:2]))


def test_many_blocks_and_copies(spark):
    """A third of the rows are one vector; blocks are small, so a query's radius is found in each."""
    rng = np.random.default_rng(3)
    rows = [(i, [1.0, 2.0, 3.0, 4.0]) if i % 3 == 0 else (i, rng.normal(size=4).tolist()) for i in range(600)]
    found = sorted(map(tuple, hs.nearest(frame(spark, rows), every=30, k=5, wanted=300, bits=64, block_rows=150).collect()))
    same(found, sorted(brute(rows, 30, 5)))


def test_empty(spark):
    assert hs.nearest(frame(spark, [])).collect() == []
    assert hs.nearest(frame(spark, [(0, [0.0]), (50, None)])).collect() == []
    assert hs.nearest(frame(spark, [(0, [1.0])])).collect() == []


def recall(found, vectors, every=50, k=5):
    ids, x = np.array([r[0] for r in vectors]), np.array([r[1] for r in vectors], float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    hits = total = 0
    for row in np.flatnonzero(ids % every == 0):
        cosines = x @ x[row]
        cosines[row] = -2
        best = set(ids[np.argsort(-cosines)[:k]].tolist())
        hits += len(best & {r[2] for r in found if r[0] == ids[row]})
        total += len(best)
    return hits / total


def test_recall(spark):
    vectors = table(spark, CHECK_DIR, "embeddings")
    rows = [(r[0], r[1]) for r in vectors.select("vec_id", "embedding").collect()]
    assert recall(hs.nearest(vectors, wanted=60).collect(), rows) >= 0.9
    assert recall(hs.nearest(vectors).collect(), rows) >= 0.98


def test_rotation_is_learned():
    """Signs after learned rotations rank neighbours better than signs as they are."""
    rng = np.random.default_rng(4)
    x = rng.normal(size=(1500, 32)) * np.linspace(3, 0.05, 32)
    mean, projection = hs.learned_rotations(x, 64)
    assert projection.shape == (32, 64)
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    learned, plain = (unit - mean) @ projection > 0, unit > 0
    near = np.argsort(-(unit[:50] @ unit.T), axis=1)[:, 1:11]

    def hit(codes):
        distance = (codes[:50, None] != codes[None]).sum(2) / codes.shape[1]
        distance[np.arange(50), np.arange(50)] = 9
        best = np.argsort(distance, axis=1, kind="stable")[:, :50]
        return np.mean([len(set(a) & set(b)) for a, b in zip(near, best)])

    assert hit(learned) > hit(plain)


def test_bits_are_whole_words(spark):
    with pytest.raises(ValueError):
        hs.nearest(frame(spark, [(0, [1.0])]), bits=100)
