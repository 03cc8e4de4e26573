"""Language models: probabilities, held-out accuracy, rejection, odd rows."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import numpy as np

from carebook.llm import language as lm
from tests.llm.data import CLASHING, documents, empty, odd_rows

SYLLABLES = {"aa": ["ka", "lo", "mi", "tun", "res"], "bb": ["ßen", "ich", "ver", "lo", "gut"], "cc": ["été", "que", "mi", "oir", "eau"]}


def text(rnd, lang, n):
    return " ".join("".join(rnd.choice(SYLLABLES[lang]) for _ in range(rnd.randint(1, 4))) for _ in range(n)).capitalize() + "."


def corpus(n=240):
    rnd = random.Random(11)
    rows = []
    for i in range(n):
        lang = rnd.choice(sorted(SYLLABLES))
        rows.append((i, text(rnd, lang, rnd.randint(3, 60)), lang))
    return rows


def test_probabilities_sum_to_one(spark):
    model = lm.fit(documents(spark, corpus()))
    assert model["languages"] == ["aa", "bb", "cc"]
    symbols = sorted({c for syllables in SYLLABLES.values() for s in syllables for c in s} | {"\x03"})
    for context in ("\x02\x02\x02", "\x02ka", "kal", "été", "qqq"):
        codes = np.frombuffer("".join(context + s for s in symbols).encode("utf-32-le"), np.uint32)
        p = np.exp(lm._log_probabilities(model, codes, np.arange(3, len(codes), 4)).astype(float)).sum(0)
        assert (np.abs(p - 1) < 2 / len(symbols)).all() and (p < 1.03).all()  # the rest is for unseen characters


def test_counts_cover_all_text(spark):
    rows = [(1, "ab ab. AB", "xx"), (2, "ab", "yy"), (3, None, "xx"), (4, "ab", None), (5, "ab", "xx")]
    got = {(r.lang, r.run): r.n for r in lm.run_counts(documents(spark, rows)).collect()}
    assert got["xx", "\x02\x02\x02a"] == 4 and got["xx", "\x02ab\x03"] == 4 and got["yy", "\x02ab\x03"] == 1 and len(got) == 6


def test_identify(spark):
    rnd = random.Random(12)
    rows = corpus() + [(1000 + i, t, None) for i, (_, t) in enumerate(odd_rows(rnd)) if t] + [(1100, None, "aa"), (1101, "12 + 34", "aa"), (None, "kalo mi", None)]
    rows += [(2000, " ".join("xqzw"[rnd.randrange(4):] * 3 for _ in range(200)), None)]
    got = {r.doc_id: r for r in lm.identify(documents(spark, rows).repartition(3)).collect()}
    assert len(got) == len({r[0] for r in rows})
    held = [(i, lang) for i, _, lang in corpus() if zlib.crc32(str(i).encode()) % 3 == 1]
    assert all(got[i].held_out == (zlib.crc32(str(i).encode()) % 3 == 1) for i in range(240))
    assert sum(got[i].lang_pred == lang for i, lang in held) >= 0.98 * len(held) and len(held) > 50
    assert not any(got[i].rejected for i in range(240))
    for i in (1100, 1101):
        assert (got[i].lang_pred, got[i].score, got[i].rejected) == ("und", 0.0, True)
    assert got[2000].rejected and all(0 <= r.score <= 1 for r in got.values()) and not got[None].held_out

    kept = lm.accepted(documents(spark, rows))
    assert kept.columns == ["doc_id", "text", "lang", *CLASHING]
    assert sorted(r.doc_id or -1 for r in kept.collect()) == sorted(i or -1 for i, _, _ in rows if not got[i].rejected)


def test_predictions_use_the_text_alone(spark):
    rows = corpus()
    once = {r.doc_id: (r.lang_pred, r.score) for r in lm.identify(documents(spark, rows)).collect()}
    moved = [(i, t, "aa" if zlib.crc32(str(i).encode()) % 3 == 1 else lang) for i, t, lang in rows]  # labels of held-out rows
    assert once == {r.doc_id: (r.lang_pred, r.score) for r in lm.identify(documents(spark, moved)).collect()}


def test_a_model_in_tables_scores_like_a_whole_one(spark):
    rnd = random.Random(14)
    few = [(5000 + i, "".join(rnd.choice("xyzq") for _ in range(6)), "dd") for i in range(3)]  # a language with few rows
    rows = corpus(150) + few + [(6000, "unseen ñandú xq", None), (6001, few[0][1], None), (6002, None, None), (6003, "12 + 1", None), (6004, "", None),
                                (6005, "kalo " * 9000 + "x" * 30_000, None), (6006, "kalo", None), (6006, "kalo", None), (None, "Ünï é", None)]
    table = documents(spark, rows)
    whole, divided = lm.fit(table), lm.fit(table, max_runs=120)
    assert "tables" in divided and "tables" not in whole and divided["floor"] == whole["floor"]

    def told(model):
        return sorted(((r.doc_id or -1, r.text_key, r.lang, r.lang_pred, r.symbols, r.wordless, r.score, r.entropy)
                       for r in lm.scored(table.repartition(3), model).collect()), key=str)
    one, got = told(whole), told(divided)
    assert [r[:6] for r in one] == [r[:6] for r in got] and len(got) == len(rows)
    assert np.allclose([r[6:] for r in one], [r[6:] for r in got], atol=1e-5)
    assert {r[0]: r[3] for r in got}[6001] == "dd"


def test_one_long_odd_text_does_not_widen_the_limit(spark):
    rnd = random.Random(15)
    junk = [(3000 + i, " ".join("".join(rnd.choice(SYLLABLES["aa"]) if rnd.random() < 0.3 else rnd.choice("ktmans") for _ in range(5)) for _ in range(12)), None)
            for i in range(5)]
    odd = next(i for i in range(4000, 4100) if zlib.crc32(str(i).encode()) % 3 != 1)
    rows = corpus() + [(odd, "tunres " * 2500, "aa")]  # named rightly, far below the others' entropy
    got = {r.doc_id: r for r in lm.identify(documents(spark, rows + junk).repartition(3)).collect()}
    assert got[odd].lang_pred == "aa" and all(got[i].lang_pred == "aa" for i, _, _ in junk)
    assert all(got[i].rejected for i, _, _ in junk)
    assert not any(got[i].rejected for i in range(240))


def test_empty_and_unlabelled(spark):
    assert lm.identify(empty(spark)).count() == 0
    got = lm.identify(documents(spark, [(1, "some words", None), (2, None, None)])).collect()
    assert all(r.lang_pred == "und" and r.score == 0 for r in got) and {r.doc_id: r.rejected for r in got} == {1: False, 2: True}
    rows = [(i, t, None) for i, t, _ in corpus(20)]  # nobody labelled anything: all pass
    assert sorted(r.doc_id for r in lm.accepted(documents(spark, rows + [(50, "12 + 1", None)])).collect()) == list(range(20))


def test_many_copies_do_not_set_the_limit(spark):
    """300 copies of one text beside ordinary ones of its language: none of these is rejected, junk still is."""
    rows = [r for r in corpus(400) if r[2] != "bb"]
    copied = text(random.Random(19), "aa", 40)
    rows += [(9000 + i, copied, "aa") for i in range(300)]
    junk = [(20_000 + i, " ".join("xqzw"[random.Random(i).randrange(4):] * 3 for _ in range(200)), None) for i in range(5)]
    got = {r.doc_id: r.rejected for r in lm.identify(documents(spark, rows + junk).repartition(3)).collect()}
    assert not any(got[i] for i, _, _ in rows) and all(got[i] for i, _, _ in junk)


def test_model_equals_plain_kneser_ney(spark):
    """Log-probabilities against counting in dictionaries, by the textbook recursion."""
    rows = [(i, t, lang) for i, t, lang in corpus(40)]
    model = lm.fit(documents(spark, rows))
    counts = {}
    for _, t, lang in rows:
        for word in re.findall(r"[^\W\d_]+", t.lower()):
            padded = "\x02" * 3 + word + "\x03"
            for i in range(3, len(padded)):
                run = padded[i - 3:i + 1]
                counts.setdefault(lang, Counter())[run] += 1
    symbols = {r[-1] for c in counts.values() for r in c}

    def level(c, k):
        for _ in range(4 - k):
            c = Counter(g[1:] for g in c)
        return c

    def p(c, run):
        if not run:
            return 1 / (len(symbols) + 1)
        own = level(c, len(run))
        once, twice = sum(v == 1 for v in own.values()), sum(v == 2 for v in own.values())
        d = once / (once + 2 * twice) if once and twice else 0.5
        after = [v for g, v in own.items() if g[:-1] == run[:-1]]
        below = p(c, run[1:])
        return (max(own[run] - d, 0) + d * len(after) * below) / sum(after) if after else below

    runs = sorted({r for c in counts.values() for r in c})[::37] + ["zzzz", "\x02\x02\x02z", "kalo", "ßenk"]
    codes = np.frombuffer("".join(runs).encode("utf-32-le"), np.uint32)
    got = lm._log_probabilities(model, codes, np.arange(3, len(codes), 4))
    want = np.log([[p(counts[lang], r) for lang in model["languages"]] for r in runs])
    assert np.allclose(got, want, atol=1e-4)
