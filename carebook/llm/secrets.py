"""Secret scan with one automaton for all rules.

Pass 1 runs the combined automaton over every byte of every text and marks
where a rule is met. Pass 2 looks only at the stretches around marks, bounded
by bytes that no match can contain, and reads the spans off the rules' own
automata: leftmost, longest, not overlapping within a kind.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carebook.llm.automaton import Automaton, hits
from carebook.llm.common import on_workers
from carebook.llm.tokenizing import slices


@dataclass(frozen=True)
class Rule:
    """``head`` then ``body``; a match counts if ``body`` (``whole``: all of it) has ``least`` bytes.

    The longest match of ``head`` must be the one the whole rule takes, and with
    ``whole`` the head is plain text.
    """

    kind: str
    head: str
    body: str
    least: int
    whole: bool = False

    def scanned(self) -> str:
        """A rule that every counted match meets."""
        return f"(?:{self.head}){self.body}{{{self.least - (len(self.head) if self.whole else 0)},}}"


# The kinds whose spans make up the base set, in their order.
BASE_RULES = (
    Rule("assign", r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?""", r"[A-Za-z0-9+/_.=-]", 12),
    Rule("access", r"AKIA", r"[A-Z0-9]", 18, whole=True),
    Rule("hex", r"", r"[0-9a-f]", 16, whole=True),
)
# Beyond the base set: headers of private keys, whatever the key's type.
MORE_RULES = (Rule("pem", r"-----BEGIN\x20([A-Z]+\x20)*PRIVATE\x20KEY(\x20BLOCK)?", r"-", 5),)
RULES = BASE_RULES + MORE_RULES


class Scanner:
    def __init__(self, rules: tuple[Rule, ...] = RULES):
        self.rules = rules
        self.all = Automaton([r.scanned() for r in rules], anywhere=True)
        self.matches = [Automaton([f"(?:{r.head})(?:{r.body})+"], anywhere=False) for r in rules]
        self.heads = [Automaton([r.head], anywhere=False) if r.head else None for r in rules]
        self._prepare()

    def _prepare(self) -> None:
        # Bytes that may begin a match of each rule.
        self.begins = [np.flatnonzero(m.next[0][m.class_of] != m.dead) for m in self.matches]

    def arrays(self) -> tuple:
        return (self.all.arrays(), [m.arrays() for m in self.matches], [h and h.arrays() for h in self.heads])

    @classmethod
    def of_arrays(cls, arrays: tuple, rules: tuple[Rule, ...] = RULES) -> Scanner:
        self = cls.__new__(cls)
        self.rules = rules
        self.all = Automaton.of_arrays(arrays[0])
        self.matches = [Automaton.of_arrays(a) for a in arrays[1]]
        self.heads = [a and Automaton.of_arrays(a) for a in arrays[2]]
        self._prepare()
        return self

    def spans(self, text: bytes, low: int, high: int) -> list[tuple[int, int, int]]:
        """(start, rule, end) in bytes of the matches in text[low:high]."""
        part, found = text[low:high], []
        raw = np.frombuffer(part, np.uint8)
        for r, rule in enumerate(self.rules):
            match, head, done = self.matches[r], self.heads[r], 0
            first = np.zeros(256, bool)
            first[self.begins[r]] = True
            for at in np.flatnonzero(first[raw]).tolist():
                if at < done:
                    continue
                end = match.longest(part, at)
                if end < 0:
                    continue
                done = end
                body = at if rule.whole or head is None else head.longest(part, at)
                if end - body >= rule.least:
                    found.append((low + at, r, low + end))
        return found

    def scan(self, texts: list[bytes]) -> list[list[tuple[int, int, int]]]:
        """Spans of each text, (start, rule, end) in code points, by start and rule."""
        out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
        data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
        ends = np.cumsum(np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts)))
        marks = hits(self.all, data)
        if not len(marks):
            return out
        resets = np.flatnonzero(self.all.resets[data])
        stretch = np.unique(np.searchsorted(resets, marks))
        for s in stretch.tolist():
            low = int(resets[s - 1]) + 1 if s else 0
            high = int(resets[s])
            doc = int(np.searchsorted(ends, low, side="right"))
            base = int(ends[doc - 1]) if doc else 0
            out[doc] += self.spans(texts[doc], low - base, high - base)
        return [sorted(_code_points(texts[i], found)) if found else found for i, found in enumerate(out)]


def _code_points(text: bytes, spans: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    if text.isascii():
        return spans
    raw = np.frombuffer(text, np.uint8)
    at = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])  # code points begun before each byte
    return [(int(at[a]), r, int(at[b])) for a, r, b in spans]


@cache
def compiled() -> tuple:
    """The rules' automata as arrays; compiled once, on the driver, whatever the data."""
    return Scanner().arrays()


def _scan_batches(batches: Iterator[pa.RecordBatch], arrays: tuple) -> Iterator[pa.RecordBatch]:
    scan = Scanner.of_arrays(arrays)
    for batch in batches:
        for part in slices(batch, "text", 4 << 20):
            texts = [t or b"" for t in part.column("text").cast(pa.large_binary()).to_pylist()]
            found = [[{"kind": scan.rules[r].kind, "start": a, "end": b} for a, r, b in spans] for spans in scan.scan(texts)]
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(found, _SPANS)], names=["doc_id", "spans"])


_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


def find_secrets(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``spans`` (array of kind, start, end) of every row of ``docs``.

    Spans are in code points, end exclusive, ordered by start and then by the
    rules' order. A null text is the empty text; null and repeated doc_ids are
    kept, each row is scanned by itself; texts are scanned whole; columns
    besides ``doc_id`` and ``text`` are not read. An empty table gives no rows.
    Letters match in either case only where a rule says so, and only A-Z.
    """
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        on_workers(__name__, "_scan_batches", compiled()), "doc_id long, spans array<struct<kind:string,start:long,end:long>>")


def secret_digests(found: DataFrame) -> DataFrame:
    """Counts of the base kinds, a digest of their spans, and all spans as text."""
    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def count(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["kind"].isin([r.kind for r in BASE_RULES]))
    return found.select("doc_id", *[count(r.kind) for r in BASE_RULES],
                        F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))


def _branch(number: int, rule: Rule) -> str:
    """SQL for the matches of one rule, in the order of the text: its pattern's matches, those with too short a body dropped."""
    head = re.sub(r"\(\?i:([^)]*)\)", lambda m: "(?:" + re.sub("[a-z]", lambda c: f"[{c[0].upper()}{c[0]}]", m[1]) + ")", rule.head)
    head = re.sub(r"\((?!\?)", "(?:", head).replace("'", "''")
    plain = re.sub(r"\\x(..)", lambda m: chr(int(m[1], 16)), head)
    pattern, body = f"{head}({rule.body}+)", rule.least - (len(plain) if rule.whole else 0)
    return f"""
  SELECT r, {number} AS k, '{rule.kind}' AS kind, {body} AS least,
         unnest(list_concat(regexp_extract_all(t, '{pattern}'), [''])) AS hit,
         unnest(list_concat(regexp_extract_all(t, '{pattern}', 1), [''])) AS body,
         unnest(regexp_split_to_array(t, '{pattern}')) AS gap,
         generate_subscripts(regexp_split_to_array(t, '{pattern}'), 1) AS i
  FROM d WHERE regexp_matches(t, '{pattern}')"""


_COUNTS = ", ".join(f"count(*) FILTER (WHERE k = {k}) AS n_{r.kind}" for k, r in enumerate(BASE_RULES))
_ZEROS = ", ".join(f"coalesce(n_{r.kind}, 0) AS n_{r.kind}" for r in BASE_RULES)
# A match begins after all earlier matches and the gaps before them, its own included.
ORACLE = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
m AS ({" UNION ALL".join(_branch(k, rule) for k, rule in enumerate(RULES))}
),
placed AS (
  SELECT r, k, kind, body, least, length(hit) AS size,
         sum(length(gap) + length(hit)) OVER (PARTITION BY r, k ORDER BY i ROWS UNBOUNDED PRECEDING) AS stop
  FROM m
),
s AS (SELECT r, k, (stop - size)::BIGINT AS start, kind || ':' || (stop - size)::BIGINT || ':' || stop::BIGINT AS span
      FROM placed WHERE size > 0 AND length(body) >= least),
found AS (
  SELECT r, {_COUNTS},
         string_agg(span, ',' ORDER BY start, k) FILTER (WHERE k < {len(BASE_RULES)}) AS base,
         string_agg(span, ',' ORDER BY start, k) AS spans
  FROM s GROUP BY r
)
SELECT d.doc_id::BIGINT AS doc_id, {_ZEROS}, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN found USING (r)
"""
