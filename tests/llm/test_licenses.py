"""Licence scan against a plain TF-IDF, and inheritance along directories."""

from __future__ import annotations

import math
import re
from collections import Counter

import pytest

from carebook.llm import licenses as li


def words(text):
    return re.findall(r"[^\W_]+", (text or "").lower())


def files(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, path string, text string").selectExpr("*", "1 AS directory", "2 AS licence", "3 AS score", "4 AS depth")


ROWS = [
    (1, "a/LICENSE", "Released under the MIT License."),
    (2, "a/b/LICENSE.txt", "Licensed under the Apache License, Version 2.0."),
    (3, "a/b/c/x.py", "no statement here"), (4, "a/x.py", "nothing"), (5, "a/y.py", "All rights reserved.\nmore text"),
    (6, "z/x.py", "nothing"), (7, None, "nothing"), (8, None, "Licensed under CC BY-NC 4.0. And then some more prose follows."),
    (9, "a/b/z.py", None), (10, "a/b/z.py", ""), (10, "a/b/z.py", ""), (11, "top.py", "nothing"), (12, "/abs/LICENSE", "This work is licensed under the GNU General Public License, version 3"),
    (13, "/abs/d/e/x", "x"), (14, "a/bb/x", "not below b"), (15, "d/LICENSE", "no licence at all"), (16, "d/x", "x"),
    (17, "d/COPYING", "Released under the MIT License."), (18, "d/NOTICE", "Released under the BSD 3-Clause License."), (19, "e/LICENSE/x.py", "a directory of that name"),
    (None, "a/q", "nothing"), (20, "f/x", "word " * 50_000 + "\nReleased under the MIT License.\n" + "y " * 50_000),
]


def test_inheritance(spark):
    got = {(r.doc_id, r.path): (r.licence, r.how, r.licence_dir) for r in li.licences(files(spark, ROWS).repartition(3)).collect()}
    assert got[1, "a/LICENSE"] == ("MIT", "own", None) and got[3, "a/b/c/x.py"] == ("Apache-2.0", "inherited", "a/b")
    assert got[4, "a/x.py"] == ("MIT", "inherited", "a") and got[5, "a/y.py"] == ("Proprietary", "own", None)
    assert got[6, "z/x.py"] == (None, "none", None) and got[7, None] == (None, "none", None) and got[8, None][0] == "CC-BY-NC-4.0"
    assert got[9, "a/b/z.py"] == got[10, "a/b/z.py"] == ("Apache-2.0", "inherited", "a/b") and got[11, "top.py"][1] == "none"
    assert got[13, "/abs/d/e/x"] == ("GPL-3.0", "inherited", "/abs") and got[14, "a/bb/x"] == ("MIT", "inherited", "a")
    assert got[16, "d/x"][0] in ("MIT", "BSD-3-Clause") and got[16, "d/x"][1] == "inherited" and got[19, "e/LICENSE/x.py"][1] == "none"
    assert got[None, "a/q"] == ("MIT", "inherited", "a") and got[20, "f/x"][0] == "MIT"
    assert li.licences(files(spark, ROWS)).count() == len(ROWS)
    assert li.licences(files(spark, ROWS).where("false")).count() == 0


def test_scores_equal_plain_cosines(spark):
    rows = ROWS + [(30, "g/COPYING", "Some words of our own.\nReleased under\nthe MIT License of nobody"), (31, "g/a", "words of our own, no licence of the work")]
    texts = [r[2] for r in rows]
    df = Counter(w for t in texts for w in set(words(t)))
    n = len(texts)

    def vector(text):
        return {w: c * (1 + math.log((1 + n) / (1 + df[w]))) for w, c in Counter(words(text)).items()}

    def cosine(a, b):
        dot = sum(v * b.get(w, 0) for w, v in a.items())
        return dot / math.sqrt(sum(v * v for v in a.values()) * sum(v * v for v in b.values())) if dot else 0.0

    checked = 0
    for r in li.licences(files(spark, rows)).where("how = 'own'").collect():
        text = next(t for i, p, t in rows if (i, p) == (r.doc_id, r.path))
        parts = re.split(r"\n|[.!?;][ \t\r]+", text) + [s for s in re.split(li._WRAPPED.replace(r"\p{L}\p{N}", r"\w"), text) if "\n" in s]
        parts += [text] if re.match(r"(?i)(licen[cs]e|copying|notice)", r.path.rpartition("/")[2] if r.path else "") else []
        third = bool(re.search(li.THIRD_CLAUSE, text))
        best = max((cosine(vector(s), vector(t)), -i, name) for s in parts for i, (name, t) in enumerate(li.TEMPLATES)
                   if li.required(name, t) <= set(words(s)) and li.by_clauses(name, t) != ("BSD-2-Clause" if third else "BSD-3-Clause"))
        assert r.score == pytest.approx(best[0]) and r.licence == best[2] and r.score >= li.MIN_COSINE
        checked += 1
    assert checked >= 8


def wrapped(text, mark=""):
    return "\n".join(mark + line for line in re.findall(r".{1,60}(?:\s|$)", text))


def test_whole_texts_headers_and_identifiers(spark):
    """Licence files, headers and identifier lines are named rightly, near relatives too; others are not named."""
    whole = {name: text for name, text in li.TEMPLATES if text.count(". ") >= 1}
    rows = [(i, f"{name}/LICENSE", f"Copyright (c) 2021 Some One\n\n{wrapped(text)}\n") for i, (name, text) in enumerate(sorted(whole.items()))]
    want = {i: name for i, name in enumerate(sorted(whole))}
    assert {"BSD-2-Clause", "BSD-3-Clause", "MIT", "ISC", "Apache-2.0"} <= set(want.values())
    apache = "                                 Apache License\n                           Version 2.0, January 2004\n                        http://www.apache.org/licenses/\n\n   TERMS AND CONDITIONS FOR USE"
    lesser = "                   GNU LESSER GENERAL PUBLIC LICENSE\n                       Version 3, 29 June 2007\n\n Copyright (C) 2007 Free Software Foundation"
    general = "                    GNU GENERAL PUBLIC LICENSE\n                       Version 2, June 1991\n\n Copyright (C) 1989"
    more = [("Apache-2.0", "x/LICENSE", apache), ("LGPL-3.0", "y/COPYING", lesser), ("GPL-2.0", "z/COPYING", general),
            ("MIT", "a.c", "// SPDX-License-Identifier: MIT\nint x;"), ("BSD-2-Clause", "b.c", "/* SPDX-License-Identifier: BSD-2-Clause */"),
            ("GPL-2.0", "c.c", "# SPDX-License-Identifier: GPL-2.0-or-later"), ("GPL-3.0", "d.c", "# SPDX-License-Identifier: GPL-3.0-only"),
            (None, "e.c", "# SPDX-License-Identifier: Vendor-5.1"), (None, "f.c", "licensed under the Apache License, Version 1.1"),
            ("BSD-3-Clause", "g.py", wrapped(whole["BSD-3-Clause"], "# ")), ("BSD-2-Clause", "h.py", wrapped(whole["BSD-2-Clause"], "# ")),
            ("CC-BY-NC-ND-4.0", "i.md", "Text.\nLicensed under CC BY-NC-ND 4.0.")]
    for i, (name, path, text) in enumerate(more, 100):
        rows.append((i, f"p{i}/{path}", text))
        want[i] = name
    rows += [(1000 + i, f"q/{i}.py", f"some other words of file {i}, version {i % 7} of the code") for i in range(200)]
    got = {r.doc_id: r.licence for r in li.licences(files(spark, rows)).collect()}
    assert {i: got[i] for i in want} == want and not any(got[1000 + i] for i in range(200))


def test_a_common_word_weighs_little(spark):
    def scored(n):
        rows = [(i, f"p/{i}", f"plain widget row{i}") for i in range(n)] + [(n, "q/x", "Released under the MIT License widget")]
        r = li.licences(files(spark, rows).repartition(3)).where(f"doc_id = {n}").first()
        return r.licence, r.score
    got = [scored(n) for n in (20, 3000)]
    for n, (licence, score) in zip((20, 3000), got):
        rare = 5 * (1 + math.log((2 + n) / 2)) ** 2  # five words in one file, and "widget" in all
        assert licence == "MIT" and score == pytest.approx(math.sqrt(rare / (rare + 1)))


def test_wrapped_statements_of_ordinary_files(spark):
    mit = next(t for n, t in li.TEMPLATES if n == "MIT" and "sublicense" in t)
    apache = next(t for n, t in li.TEMPLATES if n == "Apache-2.0" and "compliance" in t)
    bsd = next(t for n, t in li.TEMPLATES if n == "BSD-3-Clause" and "Redistribution" in t)

    def wrap(text, mark):
        return "\n".join(mark + line for line in re.findall(r".{1,40}(?:\s|$)", text))
    rows = [(1, "a.py", f"# Copyright 2020 someone\n#\n{wrap(mit, '# ')}\n#\n# The above\ncode"), (2, "b.c", f"/*\n{wrap(apache, ' * ')}\n */\nint x;"),
            (3, "c.go", f"{wrap(bsd, '// ')}\n//\n// Neither the names of the authors may be used to endorse products.\n"), (4, "d.py", "a plain text\nover two lines")]
    rows += [(10 + i, f"{i}.py", f"some other words\nof file {i}") for i in range(300)]
    got = {r.doc_id: r.licence for r in li.licences(files(spark, rows)).collect()}
    assert got == {1: "MIT", 2: "Apache-2.0", 3: "BSD-3-Clause", **{r[0]: None for r in rows[3:]}}
