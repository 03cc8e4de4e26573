"""Fingerprints, the trie self-join and components against brute force."""

from __future__ import annotations

import random
import re

import numpy as np
from xxhash import xxh64_intdigest

from carebook.llm import simhash, simhash_sql
from carebook.llm.components import connected_components
from tests.llm.data import CLASHING, documents, empty, odd_rows, prose


def fingerprint(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not words:
        return 0
    hashes = [xxh64_intdigest(" ".join(words[k:k + 3]).encode(), 42) for k in range(max(1, len(words) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(values, budget):
    near = np.bitwise_count(values[:, None] ^ values[None, :]) <= budget
    label = np.arange(len(values))
    while True:
        new = np.where(near, label[None, :], len(values)).min(1)
        if (new == label).all():
            return label
        label = new


def cloud(seed, centres, each, flips):
    rng = np.random.default_rng(seed)
    values = {int(x) for x in rng.integers(0, 2 ** 63, size=centres, dtype=np.uint64)}
    for centre in list(values):
        for _ in range(each):
            x = centre
            for _ in range(int(rng.integers(1, flips))):
                x ^= 1 << int(rng.integers(0, 64))
            values.add(x)
    return np.array(sorted(values), np.uint64)


def test_trie_finds_every_component():
    for seed in range(12):
        for budget in (0, 1, 2, 3):
            values = cloud(seed, 5, 50, 6)
            assert (simhash.trie_links(values, np.zeros(len(values), int), budget) == components(values, budget)).all()


def test_trie_keeps_groups_apart():
    values = np.array([1, 2, 1, 3], np.uint64)
    assert simhash.trie_links(values, np.array([0, 0, 1, 1]), 2).tolist() == [0, 0, 2, 2]
    assert simhash.trie_links(np.zeros(0, np.uint64), np.zeros(0, int), 2).tolist() == []


def test_links_when_tries_are_divided(spark):
    values = np.concatenate([cloud(3, 1, 400, 5), cloud(4, 60, 2, 4)])
    frame = spark.createDataFrame([(int(v),) for v in values.view(np.int64)], "fingerprint long")
    want = components(np.sort(values), 2)
    for bound in (10, 100_000):
        got = {r.node: r.component for r in connected_components(simhash.links(frame, 2, max_trie=bound)).collect()}
        ordered = np.sort(values).view(np.int64).tolist()
        groups = {}
        for v, label in zip(ordered, want.tolist()):
            groups.setdefault(label, set()).add(v)
        for members in groups.values():
            assert len({got.get(v, v) for v in members}) == 1
        assert len({got.get(v, v) for v in ordered}) == len(groups)


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(60)] + [(1000, 1000 + i) for i in range(200)] + [(5, 5), (None, 3), (7, None)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**{i: 0 for i in range(61)}, **{1000 + i: 1000 for i in range(200)}}
    assert connected_components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_near_duplicates(spark):
    rnd = random.Random(4)
    rows = odd_rows(rnd)
    text = prose(rnd, 400).split(" ")
    for i in range(30):  # near copies
        copy = list(text)
        copy[rnd.randrange(len(copy))] = "changed"
        rows.append((50 + i, " ".join(copy)))
    rows += [(200 + i, " ".join(rnd.choice("abcdefgh") * 3 for _ in range(9))) for i in range(40)]
    got = simhash.near_duplicates(documents(spark, rows)).collect()
    prints = [fingerprint(t) for _, t in rows]
    assert sorted((r.doc_id or -1, r.fingerprint) for r in got) == sorted((i or -1, f"{p:016x}") for (i, _), p in zip(rows, prints))
    label = components(np.array(prints, np.uint64), 2)
    least = {}
    for (i, _), c in zip(rows, label.tolist()):
        least[c] = min([x for x in (least.get(c), i) if x is not None], default=None)
    want = sorted((i or -1, least[c] or -1) for (i, _), c in zip(rows, label.tolist()))
    assert sorted((r.doc_id or -1, r.component_id or -1) for r in got) == want

    kept = simhash.one_per_component(documents(spark, rows))
    assert kept.columns == ["doc_id", "text", "lang", *CLASHING]
    kept = kept.collect()
    assert len(kept) == len(set(label.tolist()))
    by_print = {fingerprint(r.text): r.doc_id for r in kept}
    for (i, t), c in zip(rows, label.tolist()):
        if i is not None and least[c] == i:
            assert i in {r.doc_id for r in kept}
    assert len(by_print) == len(kept)
    assert kept == sorted(kept, key=kept.index) and all(r.row == CLASHING.index("row") for r in kept)


def test_long_text_in_windows(spark, monkeypatch):
    text = prose(random.Random(9), 3000)
    whole = simhash._fingerprints([text.encode(), b"", b"one two", b"a" * 5000 + b" b"], 3)
    monkeypatch.setattr(simhash, "WINDOW", 200)
    assert (simhash._fingerprints([text.encode(), b"", b"one two", b"a" * 5000 + b" b"], 3) == whole).all()
    assert int(whole[0]) == fingerprint(text)


def test_empty(spark):
    assert simhash.near_duplicates(empty(spark)).count() == 0
    assert simhash.one_per_component(empty(spark)).count() == 0


def test_sql_hash_equals_the_library():
    import duckdb
    import pyarrow as pa

    rnd = random.Random(4)
    texts = sorted({"".join(rnd.choice("abcé z日") for _ in range(n)) for n in list(range(150)) * 3})
    con = duckdb.connect()
    con.register("texts", pa.table({"s": texts}))
    for seed in (0, 42):
        got = dict(con.execute(f"WITH {simhash_sql.xxh64('texts', seed)} SELECT s, h FROM hashed").fetchall())
        assert got == {t: xxh64_intdigest(t.encode(), seed) for t in texts}


def test_sql_on_odd_rows(spark):
    import duckdb
    import pyarrow as pa

    rnd = random.Random(11)
    rows = odd_rows(rnd)
    for i in range(30):
        text = prose(rnd, 120)
        rows += [(100 + 3 * i, text), (101 + 3 * i, text.replace(" the ", " a ", 1)), (102 + 3 * i, text + " end")]
    con = duckdb.connect()
    con.register("documents", pa.table({"doc_id": pa.array([i for i, _ in rows], pa.int64()), "text": pa.array([t for _, t in rows], pa.string())}))

    def ordered(found):
        return sorted((tuple(r) for r in found), key=repr)

    got = simhash.near_duplicates(documents(spark, rows)).select("doc_id", "fingerprint", "component_id").collect()
    assert ordered(got) == ordered(con.execute(simhash_sql.oracle()).fetchall())
    assert len({r.component_id for r in got}) < len({r.fingerprint for r in got})  # some different fingerprints are linked
