"""Line templates against a plain version, and the SQL."""

from __future__ import annotations

import random
from collections import Counter

from carebook.llm import line_templates as lt
from tests.llm.data import CLASHING, documents, empty, odd_rows, prose


def plain(rows):
    """The kept text of each distinct (doc_id, text)."""
    from pyspark.sql import SparkSession
    docs = {(i, t) for i, t in rows if t is not None}
    lines = []
    for doc in docs:
        for n, line in enumerate(doc[1].split("\n")):
            if line.strip(" "):
                tokens = tuple("<*>" if any("0" <= c <= "9" for c in w) else w for w in line.split(" "))
                fixed = sum(w != "<*>" for w in tokens) / len(tokens) >= 0.8
                lines.append((doc, n, (len(tokens), *tokens[:3]), tokens if fixed else tuple(line.split(" ")), fixed))
    in_leaf, holders = {}, {}
    for doc, n, leaf, tokens, fixed in lines:
        if fixed:
            in_leaf.setdefault(leaf, {}).setdefault(tokens, set()).add(doc)
    names = {}
    for leaf, members in in_leaf.items():
        most = [Counter(t[i] for t in members).most_common(1)[0] for i in range(leaf[0])]
        spelled = [w if 2 * n > len(members) and w != "<*>" else None for w, n in most]
        for tokens in members:
            agreed = sum(a == b for a, b in zip(tokens, spelled))
            if len(members) > 1 and (leaf[0] - 1) / leaf[0] >= 0.8 and agreed / leaf[0] >= 0.8:
                names[leaf, tokens] = leaf
    keys = {doc: (doc[0] is None, doc[0] or 0, k) for doc, k in zip(docs, hashes(SparkSession.active(), [d[1] for d in docs]))}
    name = {(doc, n): names.get((leaf, tokens), (leaf, tokens, fixed)) if fixed else (leaf, tokens, fixed) for doc, n, leaf, tokens, fixed in lines}
    for doc, n, *_ in lines:
        holders.setdefault(name[doc, n], set()).add(doc)
    gone = {(doc, n) for doc, n, *_ in lines if doc != min(holders[name[doc, n]], key=keys.get)}
    return {doc: "\n".join(line for n, line in enumerate(doc[1].split("\n")) if (doc, n) not in gone) for doc in docs}


def hashes(spark, texts):
    rows = spark.createDataFrame(list(enumerate(texts)), "n int, t string").selectExpr("n", "xxhash64(t) AS h").collect()
    return [h for _, h in sorted(map(tuple, rows))]


def sample():
    rnd = random.Random(13)
    rows = odd_rows(rnd)
    common = [prose(rnd, n) for n in (1, 3, 9, 60)]
    for i in range(40):
        name = "".join(rnd.choice("abcdefghijklmnop") for _ in range(8))
        lines = [prose(rnd, rnd.randint(2, 14)) for _ in range(4)] + [rnd.choice(common), f"Someone in room opened the page number {i} at noon",
                                                                     f"Error in module core while reading item {name}{name} today", ""]
        rnd.shuffle(lines)
        rows.append((100 + i, "\n".join(lines)))
    return rows + [(20, "the very same line"), (21, "the very same line"), (20, "the very same line")]


def test_equals_plain_version(spark):
    rows = sample()
    got = lt.without_recurring_lines(documents(spark, rows).repartition(4))
    assert got.columns == ["doc_id", "text", "lang", *CLASHING]
    want = plain(rows)
    pairs = sorted((r.doc_id or -1, r.text is None, r.text or "") for r in got.collect())
    assert pairs == sorted((i or -1, t is None, want.get((i, t), "")) for i, t in rows)
    joined = {r.doc_id: r.text for r in got.collect()}
    assert "very same" in joined[20] and joined[21] == ""
    assert sum("opened the page" in (t or "") for t in joined.values()) == 1  # a digit varies
    assert sum("in module core" in (t or "") for t in joined.values()) == 1  # a word varies


def test_counts_and_empty(spark):
    got = {r.row.doc_id: (r.lines, r.lines_dropped) for r in lt.deduplicated(
        documents(spark, [(1, "a b\n\nc"), (2, "c\nx\nc"), (3, None), (4, "")])).collect()}
    assert got == {1: (3, 0), 2: (3, 2), 3: (0, 0), 4: (1, 0)}
    assert lt.without_recurring_lines(empty(spark)).count() == 0


def test_no_python_in_the_plan(spark):
    plan = lt.without_recurring_lines(documents(spark, [(1, "a"), (2, "a")]))._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas"))


def filled(n, seed=17):
    """Documents of one line each, from a template with two word fields of 100 values each."""
    rnd = random.Random(seed)
    pool = ["".join(rnd.choice("abcdefghijklmnop") for _ in range(7)) for _ in range(200)]
    return [(i, f"the session of {rnd.choice(pool[:100])} in {rnd.choice(pool[100:])} was closed by the service today") for i in range(n)]


def test_fields_are_found_at_any_size(spark):
    """Values that recur do not make a template of their own, however many documents there are."""
    for n in (40, 400, 4000):
        left = lt.deduplicated(documents(spark, filled(n)).repartition(4)).where("text <> ''").collect()
        assert len(left) <= 0.05 * n + 1 and min(r.row.doc_id for r in left) == 0


def test_distinct_numbers_stay(spark):
    """Lines of which too little is fixed go only where the very same line occurred before."""
    one, two = "1,2,3\n2024-01-01\n12 34 56\ntotal 12 34", "7,8,9\n4471\n90 11 4\ntotal 5 6"
    rows = [(1, one), (2, two), (3, one), (4, "Seen on page 7 of the same book"), (5, "Seen on page 9 of the same book")]
    got = {r.doc_id: r.text for r in lt.without_recurring_lines(documents(spark, rows)).collect()}
    assert got == {1: one, 2: two, 3: "", 4: rows[3][1], 5: ""}


def test_one_frequent_line_is_no_template_for_others(spark):
    """Copies of a line count once in its leaf, so they do not outvote other lines' fields."""
    rows = [(i, "we have seen the red house over there by the sea") for i in range(60)]
    rows += [(100 + i, f"we have seen {a} {b} {c} over {d} by the {a}") for i, (a, b, c, d) in enumerate(zip("abcdef", "ghijkl", "mnopqr", "stuvwx"))]
    got = {r.doc_id: r.text for r in lt.without_recurring_lines(documents(spark, rows)).collect()}
    assert sum(bool(t) for i, t in got.items() if i < 100) == 1
    assert all(t for i, t in got.items() if i >= 100)
    assert got == {i: t if (i, t) in plain(rows) and plain(rows)[i, t] else plain(rows)[i, t] for i, t in rows}
