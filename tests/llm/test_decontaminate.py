"""Decontamination against a brute-force alignment of every pair."""

from __future__ import annotations

import random
import re

import numpy as np

from carebook.llm import decontaminate as dc
from tests.llm.data import CLASHING, documents, empty, odd_rows

VOCABULARY = [a + b + c for a in ("ka", "lo", "mi", "ne", "su") for b in ("ra", "to", "vi") for c in ("n", "s", "l", "")]


def words(text):
    return re.findall(r"[^\W_]+", (text or "").lower())


def smith_waterman(a, b):
    row, best = [0] * (len(b) + 1), 0
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(max(0, row[j] + (2 if x == y else -1), row[j + 1] - 1, new[j] - 1))
        row, best = new, max(best, *new)
    return best


def sentence(rnd, n):
    return " ".join(rnd.choice(VOCABULARY) for _ in range(n))


def edited(rnd, text, rate):
    out = []
    for w in text.split():
        r = rnd.random()
        if r < rate / 3:
            continue
        out.append(rnd.choice(VOCABULARY) if r < rate * 2 / 3 else w)
        if rate * 2 / 3 <= r < rate:
            out.append(rnd.choice(VOCABULARY))
    return " ".join(out)


def test_align_equals_plain_dynamic_programme():
    rnd = random.Random(6)
    items = [np.array([rnd.randint(1, 5) for _ in range(rnd.randint(1, 12))], np.uint64) for _ in range(150)]
    passages = [np.array([rnd.randint(1, 5) for _ in range(rnd.randint(1, 20))], np.uint64) for _ in range(150)]
    best, start, end = dc.align(items, passages)
    assert best.tolist() == [smith_waterman(a.tolist(), b.tolist()) for a, b in zip(items, passages)]
    assert all(smith_waterman(a.tolist(), b[x:y].tolist()) == v for a, b, x, y, v in zip(items, passages, start, end, best))


def tables(spark):
    rnd = random.Random(7)
    items = [(i, sentence(rnd, rnd.randint(12, 40))) for i in range(12)]
    items += [(90, items[3][1].upper() + "!"), (91, None), (92, ""), (93, "two words"), (None, sentence(rnd, 20)), (94, items[5][1])]
    rows = odd_rows(rnd) + [(100 + i, sentence(rnd, 300)) for i in range(20)]
    for n, (i, text) in enumerate(items[:12]):
        rows.append((200 + n, sentence(rnd, 50) + " " + text + ". " + sentence(rnd, 50)))
        rows.append((300 + n, sentence(rnd, 80) + "\n" + edited(rnd, text, 0.15) + "\n" + sentence(rnd, 10)))
        rows.append((400 + n, " ".join(text.split()[:5])))
    rows += [(500, items[0][1])] * 3 + [(600 + i, f"{sentence(rnd, 5)} {items[1][1]}") for i in range(60)]
    return rows, items, spark.createDataFrame(items, "item_id long, text string")


def test_contaminated_equals_all_pairs(spark):
    rows, items, table = tables(spark)
    distinct = {}
    for i, t in items:
        if i is not None and len(words(t)) >= dc.SEED_WORDS:
            key = tuple(words(t))
            distinct[key] = min(i, distinct.get(key, i))
    want = []
    for i, text in rows:
        own = words(text)
        for key, item in distinct.items():
            score = smith_waterman(list(key), own) / (2 * len(key)) if own else 0
            if score >= 0.5:
                want.append((i or -1, item, round(score, 6)))
    for block_words in (dc.BLOCK_WORDS, 60):  # one block of items, and several
        got = dc.contaminated(documents(spark, rows).repartition(3), table, block_words=block_words).collect()
        assert sorted((r.doc_id or -1, r.item_id, round(r.score, 6)) for r in got) == sorted(want)
    assert {200 + n for n in range(12)} | {300 + n for n in range(12)} <= {w[0] for w in want}
    by_id = dict(rows)
    for r in got:
        if r.score == 1.0 and r.doc_id is not None:
            assert words(by_id[r.doc_id])[r.start_word:r.end_word] == words(dict(items)[r.item_id])

    kept = dc.without_contaminated(documents(spark, rows), table)
    assert kept.columns == ["doc_id", "text", "lang", *CLASHING]
    bad = {w[0] for w in want}
    assert sorted(r.doc_id or -1 for r in kept.collect()) == sorted(i or -1 for i, _ in rows if (i or -1) not in bad)


def test_empty_tables(spark):
    _, items, table = tables(spark)
    none = table.where("false")
    assert dc.contaminated(empty(spark), table).count() == 0
    assert dc.contaminated(documents(spark, [(1, "a b c d e f")]), none).count() == 0
    assert dc.without_contaminated(documents(spark, [(1, "a b c d e f")]), none).count() == 1


def test_edited_copies_in_many_documents(spark):
    rnd = random.Random(8)
    own = [f"w{i}" for i in range(38)]
    copy = [*own]
    for at in (4, 9, 14, 19, 24):  # many of the runs do not survive
        copy[at] = "other"
    runs = {tuple(own[i:i + 4]) for i in range(35)}
    assert 2 * len(runs & {tuple(copy[i:i + 4]) for i in range(35)}) < len(runs)
    rows = [(i, f"{sentence(rnd, 30)} {' '.join(copy)} {sentence(rnd, 30)}") for i in range(40)] + [(100 + i, sentence(rnd, 90)) for i in range(9)]
    items = spark.createDataFrame([(1, " ".join(own))], "item_id long, text string")
    got = {r.doc_id: round(r.score, 6) for r in dc.contaminated(documents(spark, rows), items).collect()}
    assert got == {i: round(smith_waterman(own, copy) / 76, 6) for i in range(40)}


def test_recall_of_edited_copies(spark):
    """Copies with up to 30 % of their words replaced that still score half: nine of ten are found, short items too."""
    rnd = random.Random(9)
    for length, rate in ((8, 0.2), (8, 0.3), (12, 0.3), (20, 0.3), (40, 0.3)):
        items = [(i, " ".join(f"v{rnd.randrange(3000)}" for _ in range(length))) for i in range(150)]
        rows, want = [], set()
        for i, t in items:
            copy = [w if rnd.random() >= rate else f"x{rnd.randrange(3000)}" for w in t.split()]
            if smith_waterman(t.split(), copy) >= length:
                want.add(i)
            rows.append((i, f"{sentence(rnd, 20)} {' '.join(copy)} {sentence(rnd, 20)}"))
        got = dc.contaminated(documents(spark, rows), spark.createDataFrame(items, "item_id long, text string")).collect()
        found = {r.doc_id for r in got if r.doc_id == r.item_id}
        assert found <= want and len(found) >= 0.9 * len(want) and len(want) > 30, (length, rate, len(found), len(want))


def test_a_common_opening_aligns_nothing(spark, monkeypatch):
    """Items that open alike, and documents that hold the opening: no pair of them is aligned, whole copies still are."""
    import pyarrow as pa
    rnd = random.Random(10)
    opening = "which of the following statements about"
    items = [(i, f"{opening} {sentence(rnd, 20)}") for i in range(300)]
    offsets, words = dc._word_hashes(pa.array([t for _, t in items]))
    rows = pa.table({"item_id": list(range(300)), "words": pa.ListArray.from_arrays(pa.array(offsets.astype("int32")), pa.array(words.view("int64")))})
    block = dc._item_arrays(rows)
    docs = [f"{' '.join(f'u{rnd.randrange(10 ** 6)}' for _ in range(40))} {opening} {' '.join(f'u{rnd.randrange(10 ** 6)}' for _ in range(40))}" for _ in range(50)]
    docs += [f"some words {t}" for _, t in items[:5]]
    offsets, words = dc._word_hashes(pa.array(docs))
    doc, item, _, _ = dc._passages(block, offsets, words, 0.5)
    assert set(zip(doc[doc < 50].tolist(), item[doc < 50].tolist())) == set()
    assert {(50 + i, i) for i in range(5)} <= set(zip(doc.tolist(), item.tolist()))


def test_short_items(spark):
    items = spark.createDataFrame([(1, "alpha beta gamma"), (2, "delta epsilon")], "item_id long, text string")
    rows = [(1, "so alpha beta gamma it is"), (2, "delta epsilon"), (3, "alpha beta"), (4, "alpha, Beta: gamma")]
    assert sorted(r.doc_id for r in dc.contaminated(documents(spark, rows), items).collect()) == [1, 4]
