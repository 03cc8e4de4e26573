"""The registered queries and the pipeline, stage by stage."""

from __future__ import annotations

import os
import tempfile

import duckdb
import pytest

import corpus_pipeline
from carebook.llm import language, line_templates, simhash
from carebook.llm.queries import ORACLE_SQL, QUERIES
from tests.oracle_harness import normalize

SMALL = "/root/testdata/sf0.001"


def test_every_operator_has_one_query():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "line_templates", "simhash", "decontamination", "packing"]


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_sql_gives_the_same_rows(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "conversations", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    df = QUERIES[name](spark, SMALL)
    cur = con.execute(ORACLE_SQL[name])
    assert normalize(df.columns, [tuple(r) for r in df.collect()]) == normalize([c[0] for c in cur.description], cur.fetchall())


def test_stages(spark):
    columns = spark.read.parquet(f"{SMALL}/documents.parquet").columns
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SMALL)
        path = tempfile.mkdtemp(prefix="carebook-stage-") + "/out"
        out.write.parquet(path)
        before, docs = docs, spark.read.parquet(path)
        kept[name] = (before, docs)
    for name, (before, after) in list(kept.items())[:-1]:
        assert after.columns == columns and after.count() <= before.count()
    before, after = kept["language"]
    gone = {r.doc_id for r in language.identify(before).where("rejected").collect()}
    assert {r.doc_id for r in after.collect()} == {r.doc_id for r in before.collect()} - gone
    before, after = kept["line_templates"]
    texts = {r.doc_id: r.text for r in line_templates.without_recurring_lines(before).collect()}
    assert all(texts[r.doc_id] == r.text and r.n_chars == len(r.text) for r in after.collect())
    assert all(not texts[r.doc_id].strip() for r in before.join(after, "doc_id", "left_anti").collect())
    before, after = kept["simhash"]
    found = {r.doc_id: r.component_id for r in simhash.near_duplicates(before).collect()}
    assert {r.doc_id for r in after.collect()} == set(found.values())
    before, after = kept["decontamination"]
    items = [r.text for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    assert not any(t in r.text for r in after.collect() for t in items)
    before, after = kept["packing"]
    assert {r.doc_id for r in after.collect()} == {r.doc_id for r in before.collect()}
    whole = corpus_pipeline.run(spark, SMALL).select("doc_id", "start", "length", "ids_crc32")
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, after.select("doc_id", "start", "length", "ids_crc32").collect()))


def test_odd_tables(spark, tmp_path):
    """Null and repeated ids, null, empty, blank and very long texts, no labels, and no rows at all."""
    import random
    import shutil

    from tests.llm.data import odd_rows, prose
    shutil.copy(f"{SMALL}/benchmark.parquet", f"{tmp_path}/benchmark.parquet")
    rnd = random.Random(21)
    clean = [(500 + i, prose(rnd, 80)) for i in range(20)]
    rows = odd_rows(rnd) + clean + clean[:3]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    for made in (rows, []):
        docs = spark.createDataFrame([(i, t, None, None, None if t is None else len(t)) for i, t in made], schema)
        ids = []
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, str(tmp_path))
            path = tempfile.mkdtemp(prefix="carebook-odd-") + "/out"
            out.write.parquet(path)
            docs = spark.read.parquet(path)
            if name != "packing":
                assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
            ids.append({r.doc_id for r in docs.select("doc_id").collect()})
        # Nothing is labelled: only rows without letters are rejected, and every clean document is packed.
        assert ids[0] == ({i for i, t in made if t and any(c.isalpha() for c in t)})
        assert {i for i, _ in made if i and i >= 500} <= ids[-1]


def test_the_rest_does_not_need_the_operators():
    import subprocess
    import sys
    code = ("import sys, importlib.abc\n"
            "class Gone(importlib.abc.MetaPathFinder):\n"
            "    def find_spec(self, name, path, target=None):\n"
            "        if name.startswith('carebook.llm') or name == 'corpus_pipeline': raise ModuleNotFoundError(name, name=name)\n"
            "sys.meta_path.insert(0, Gone())\n"
            "import __spark_entry__ as e\n"
            "assert 'pipeline' not in e.queries() and len(e.queries()) > 20\n")
    root = os.path.dirname(os.path.abspath(corpus_pipeline.__file__))
    subprocess.run([sys.executable, "-c", code], cwd=root, check=True, timeout=120)


class PlainModel:
    """Interpolated Kneser-Ney counted in dictionaries, one language."""

    def __init__(self, texts, floor):
        from collections import Counter
        counts = Counter(run for t in texts for run in runs(t))
        self.levels, self.floor, self.kept = {4: counts}, floor, {"": floor}
        for k in (3, 2, 1):
            self.levels[k] = Counter(g[1:] for g in self.levels[k + 1])
        self.after = {k: {} for k in self.levels}
        for k, level in self.levels.items():
            for g, n in level.items():
                self.after[k].setdefault(g[:-1], []).append(n)

    def p(self, run):
        if run not in self.kept:
            own, after = self.levels[len(run)], self.after[len(run)].get(run[:-1])
            once, twice = sum(n == 1 for n in own.values()), sum(n == 2 for n in own.values())
            d, below = once / (once + 2 * twice) if once and twice else 0.5, self.p(run[1:])
            self.kept[run] = (max(own[run] - d, 0) + d * len(after) * below) / sum(after) if after else below
        return self.kept[run]


def runs(text):
    import re
    for word in re.findall(r"[^\W\d_]+", text.lower()):
        padded = "\x02" * 3 + word + "\x03"
        yield from (padded[i - 3:i + 1] for i in range(3, len(padded)))


def plain_language(rows):
    """Rows (doc_id, text, lang) that the language stage keeps."""
    import math
    import zlib
    train = [(t, lang) for i, t, lang in rows if t and lang and (i is None or zlib.crc32(str(i).encode()) % 3 != 1)]
    floor = 1 / (len({r[-1] for t, _ in train for r in runs(t)}) + 1)
    models = {lang: PlainModel([t for t, x in train if x == lang], floor) for lang in sorted({x for _, x in train})}
    told = {}
    for _, t, _ in rows:
        if t and (own := list(runs(t))):
            entropy = {lang: -sum(math.log(m.p(r)) for r in own) / len(own) for lang, m in models.items()}
            best = min(entropy, key=entropy.get)
            told[t] = (best, entropy[best], len(own))

    def median(values):
        return sorted(values)[(len(values) + 1) // 2 - 1]

    limit = {}
    for lang in models:
        own = [told[t][1:] for t in {t for t, x in train if x == lang and t in told} if told[t][0] == lang]
        mean, half = median([h for h, _ in own]), median([n for _, n in own])
        between = median([abs(h - mean) for h, n in own if n >= half]) / language.NORMAL_MAD
        variance = median([n * (h - mean) ** 2 for h, n in own if n <= half]) / language.NORMAL_MAD ** 2
        limit[lang] = lambda n, m=mean, b=between, v=variance: m + language.REJECT_SIGMAS * math.sqrt(max(b, language.LEAST_SIGMA) ** 2 + v / n)
    return [r for r in rows if r[1] in told and told[r[1]][1] <= limit[told[r[1]][0]](told[r[1]][2])]


def plain_pipeline(rows, items):
    """Pieces (doc_id, start, length, crc of the ids, ids of the document) of the whole pipeline."""
    import numpy as np

    from carebook.llm import packing
    from tests.llm import test_decontaminate, test_line_templates, test_simhash, test_tokens
    left = [len(rows)]
    kept = plain_language(rows)
    left.append(len(kept))
    fresh = test_line_templates.plain([(i, t) for i, t, _ in kept])
    docs = [(i, fresh[i, t]) for i, t, _ in kept if fresh[i, t] == t or fresh[i, t].replace("\n", " ").strip(" ")]
    left.append(len(docs))
    values = np.array([test_simhash.fingerprint(t) for _, t in docs], np.uint64)
    reached = test_simhash.components(values, 2).tolist()
    first = {}
    for (i, _), c in zip(docs, reached):
        first[c] = min(i, first.get(c, i))
    docs = [(i, t) for (i, t), c in zip(docs, reached) if first[c] == i]
    left.append(len(docs))
    wanted = [test_decontaminate.words(t) for _, t in items]
    docs = [(i, t) for i, t in docs
            if not any(test_decontaminate.smith_waterman(w, test_decontaminate.words(t)) >= len(w) for w in wanted)]  # half of 2 a word
    left.append(len(docs))
    out = []
    for i, t in docs:
        ids, at = test_tokens.ids_of(t, 1), 0
        for n in packing.piece_lengths(len(ids), 2048):
            out.append((i, at, n, test_tokens.crc(ids[at:at + n]), len(ids)))
            at += n
        assert at == len(ids)
    return sorted(out), left


def test_run_equals_a_plain_pipeline(spark, tmp_path):
    """The whole of ``run()`` against dictionaries, all pairs and the tokenizer itself."""
    import random

    from tests.llm.test_language import text as sentence
    rnd = random.Random(31)
    languages = ["aa", "bb"]
    items = [(n, sentence(rnd, rnd.choice(languages), rnd.randint(9, 25))) for n in range(8)]
    boiler = [sentence(rnd, lang, 8) for lang in languages]
    rows = []

    def add(text, lang=None):
        rows.append((len(rows) * 7 % 1000 + 1, text, lang))

    for _ in range(110):
        lang = rnd.choice(languages)
        lines = [sentence(rnd, lang, rnd.randint(5, 14)) for _ in range(rnd.randint(1, 6))]
        if rnd.random() < 0.4:
            lines.insert(rnd.randrange(len(lines) + 1), boiler[languages.index(lang)])
        add("\n".join(lines), lang if rnd.random() < 0.8 else None)
    for source in [r for r in rows if len(r[1]) > 200][:12]:       # the same words on other lines: no line is the same
        words = source[1].replace("\n", " ").split(" ")
        cut = rnd.randint(15, 20)
        add("\n".join(" ".join(words[a:a + cut]) for a in range(0, len(words), cut)), source[2])
    for source in rows[:5]:
        add(source[1], source[2])                                   # copies: every line goes, then the document
    for n, text in items[:6]:
        words = text.split()
        if n % 2:
            words[len(words) // 2] = sentence(rnd, "aa", 1)
        add(sentence(rnd, "aa", 20) + "\n" + sentence(rnd, "aa", 4) + " " + " ".join(words) + " " + sentence(rnd, "bb", 4), None)
    for _ in range(4):
        add(" ".join("xqzw"[rnd.randrange(4):] * 3 for _ in range(60)))
    for text in (None, "", " \n ", "12 + 34", "\n".join(sentence(rnd, "bb", 12) for _ in range(400))):
        add(text, "bb")
    assert len({i for i, _, _ in rows}) == len(rows)

    spark.createDataFrame([(i, t, lang, "s", None if t is None else len(t)) for i, t, lang in rows],
                          "doc_id long, text string, lang string, source string, n_chars long").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    want, left = plain_pipeline(rows, items)
    assert all(a > b for a, b in zip(left, left[1:])) and left[-1] > 60, left  # every stage drops some
    got = corpus_pipeline.run(spark, str(tmp_path)).select("doc_id", "start", "length", "ids_crc32", "doc_tokens")
    assert sorted(map(tuple, got.collect())) == want
