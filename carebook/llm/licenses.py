"""Licence scan: sparse TF-IDF cosine to templates, then inheritance along directories.

A file is scored by its statements (lines, their sentences, and sentences that
run over several lines) and, if its name marks it as a licence file, also as a
whole, against licence templates: statements, headers, identifiers and whole texts
(``licence_texts``). Near relatives are told apart by what sets them apart: a
statement must hold the version numbers of its template, an identifier line all of
the identifier, and of the two BSD licences, whose sentences are the same, a
file has the three-clause one if it holds the third clause. Weights come from the document frequencies of
all words over all files. A file without a licence of its own takes that of the nearest ancestor directory
that holds a licence file.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carebook.llm.common import on_workers, stored
from carebook.llm.licence_texts import SPDX_MARK, TEMPLATES, THIRD_CLAUSE
from carebook.llm.tokenizing import slices
from carebook.llm.worker_memory import drop_kept, release
from carebook.operators.broadcast import bounded_broadcast

MIN_COSINE = 0.75
SLICE = 4 << 20
MAX_DIRECTORIES = 1_000_000
LICENCE_FILE = r"(?i)^(licen[cs]e|copying|notice)([-_.].*)?$"
_BREAK = r"[^\p{L}\p{M}\p{N}]+"
_SENTENCE = r"\n|[.!?;][\x20\t\r]+"
# Sentences over lines: a line without a letter or digit ends them too.
_WRAPPED = r"\n[^\p{L}\p{N}\n]*\n|[.!?;]\s+"
MAX_WORDS = 1_000_000

def _words(texts: pa.Array) -> tuple[np.ndarray, pa.DictionaryArray, np.ndarray]:
    """Offsets of each text, its words, and which of them are not empty."""
    lists = pc.split_pattern_regex(pc.utf8_lower(texts), _BREAK)
    words = pc.list_flatten(lists).dictionary_encode()
    empty = np.fromiter((not w for w in words.dictionary.to_pylist()), bool, len(words.dictionary))
    offsets = lists.offsets.to_numpy().astype(np.int64)
    return offsets - offsets[0], words, ~empty[words.indices.to_numpy()]


def _terms() -> list[str]:
    _, words, there = _words(pa.array([t for _, t in TEMPLATES]))
    return sorted(set(words.filter(pa.array(there)).to_pylist()))


def _frequency_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(term, files) of each slice, and the number of files under the empty term."""
    drop_kept()
    for batch in batches:
        for part in slices(batch, "text", SLICE):
            release()
            offsets, words, there = _words(part.column("text"))
            owner = np.repeat(np.arange(len(part)), np.diff(offsets))[there]
            seen = np.unique(words.indices.to_numpy()[there].astype(np.int64) * len(part) + owner) // max(1, len(part))
            place, n = np.unique(seen, return_counts=True)
            terms = words.dictionary.take(pa.array(place)).cast(pa.string())
            yield pa.RecordBatch.from_arrays(
                [pa.concat_arrays([terms, pa.array([""], pa.string())]), pa.array([*n.tolist(), len(part)], pa.int64())], names=["term", "files"])


def frequencies(files: DataFrame) -> DataFrame:
    """(term, files): how many files hold each word, and under the empty term the number of files."""
    texts = files.select(F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    counted = texts.mapInArrow(on_workers(__name__, "_frequency_batches"), "term string, files long")
    return stored(counted.groupBy("term").agg(F.sum("files").alias("files")), "word-files")


def weights(counted: DataFrame) -> tuple[list[str], np.ndarray, int]:
    """The templates' words, their inverse document frequencies, and the number of files."""
    terms = _terms()
    n = {r["term"]: r["files"] for r in counted.where(F.col("term").isin("", *terms)).collect()}  # one row per template word
    total = n.get("", 0)
    return terms, np.array([1 + np.log((1 + total) / (1 + n.get(t, 0))) for t in terms]), total


def required(name: str, text: str) -> set[str]:
    """Words that a statement must hold to be of this template: the numbers of its licence's version, or the whole identifier."""
    words = set(re.findall(r"[^\W_]+", text.lower()))
    if text.startswith(SPDX_MARK):
        return set(re.findall(r"[^\W_]+", text[len(SPDX_MARK):].lower()))
    return {w for w in re.findall(r"[0-9]+", name) if w in words}


def by_clauses(name: str, text: str) -> str | None:
    """Which of the two BSD licences a template stands for, if their sentences alone do not tell."""
    return name if name.startswith("BSD-") and "Redistribution" in text else None


class Scorer:
    """What cosines of statements to all templates are made of."""

    def __init__(self, terms: list[str], idf: np.ndarray):
        self.terms, self.idf = pa.array(terms), idf
        offsets, words, there = _words(pa.array([t for _, t in TEMPLATES]))
        place = pc.index_in(words.cast(pa.string()), value_set=self.terms).fill_null(-1).to_numpy()
        self.matrix = np.zeros((len(terms), len(TEMPLATES)))
        owner = np.repeat(np.arange(len(TEMPLATES)), np.diff(offsets))
        np.add.at(self.matrix, (place[there], owner[there]), idf[place[there]])
        self.matrix /= np.linalg.norm(self.matrix, axis=0)
        self.required = np.array([[t in required(*template) for template in TEMPLATES] for t in terms], np.int64).reshape(len(terms), -1)
        self.needed = self.required.sum(0)
        clauses = [by_clauses(*template) for template in TEMPLATES]
        self.two, self.three = (np.array([c == n for c in clauses]) for n in ("BSD-2-Clause", "BSD-3-Clause"))

    def products(self, texts: pa.Array, file: np.ndarray, files: pa.Array) -> tuple[np.ndarray, ...]:
        """Of the statements ``texts`` (``file`` numbers the one of ``files`` that each lies in) that hold a
        template word: their numbers, best product with
        a template, the template that has it (the first, of equal ones) and the
        squared norm of their template words. And the text, word (as a place in
        the dictionary given last) and times of each of their other words.

        A text's norm is the same for all templates, so its other words decide
        how high its best cosine is, not which template has it.
        """
        offsets, words, there = _words(texts)
        index = words.indices.to_numpy()
        term = pc.index_in(words.dictionary, value_set=self.terms).fill_null(-1).to_numpy()
        owner = np.repeat(np.arange(len(texts)), np.diff(offsets))
        some = np.unique(owner[term[index] >= 0])
        row = np.full(len(texts), -1)
        row[some] = np.arange(len(some))
        mine = (row[owner] >= 0) & there
        width = max(1, len(words.dictionary))
        pair, times = np.unique(row[owner[mine]] * width + index[mine], return_counts=True)
        r, word = pair // width, pair % width
        place = term[word]
        hit = place >= 0
        weight = self.idf[place[hit]] * times[hit]
        known = np.bincount(r[hit], weights=weight ** 2, minlength=len(some))
        dots = np.zeros((len(some), len(TEMPLATES)))
        np.add.at(dots, r[hit], weight[:, None] * self.matrix[place[hit]])
        told = np.flatnonzero(self.required[place].any(1) & hit) if len(self.terms) else np.zeros(0, np.int64)
        have = np.zeros((len(some), len(TEMPLATES)), np.int32)
        np.add.at(have, r[told], self.required[place[told]])
        dots[have < self.needed] = 0
        if len(some):
            either = np.flatnonzero((self.two | self.three)[dots.argmax(1)])
            third = pc.match_substring_regex(files.take(pa.array(file[some[either]])), THIRD_CLAUSE).to_numpy(zero_copy_only=False)
            dots[np.ix_(either[third], self.two)] = 0
            dots[np.ix_(either[~third], self.three)] = 0
        which = dots.argmax(1) if len(some) else np.zeros(0, np.int64)
        return some, dots[np.arange(len(some)), which], which, known, r[~hit], word[~hit], times[~hit], words.dictionary


def _wrapped(texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """The sentences that run over several lines, and their texts' numbers."""
    lists = pc.split_pattern_regex(texts, _WRAPPED)
    flat = pc.list_flatten(lists)
    owner = np.repeat(np.arange(len(texts)), np.diff(lists.offsets.to_numpy().astype(np.int64)))
    over = pc.match_substring(flat, "\n")
    return owner[over.to_numpy(zero_copy_only=False)], flat.filter(over)


def _score_batches(batches: Iterator[pa.RecordBatch], terms: list[str], idf: np.ndarray, rarest: float,
                   least: float) -> Iterator[pa.RecordBatch]:
    """Each file, numbered, with the statements that may be its best one.

    A word's idf is from 1 to ``rarest``, so a statement's cosine lies between
    two bounds. One that cannot reach ``least``, or another one's lower bound,
    is left out.
    """
    from pyspark import TaskContext
    scorer, number = Scorer(terms, idf), TaskContext.get().partitionId() << 40
    for batch in batches:
        for part in slices(batch, "text", SLICE):
            release()
            text = part.column("text")
            statements = pc.split_pattern_regex(text, _SENTENCE)
            lines = np.repeat(np.arange(len(text)), np.diff(statements.offsets.to_numpy().astype(np.int64)))
            wrapped, over = _wrapped(text)
            whole = np.flatnonzero(part.column("licence_file").to_numpy(zero_copy_only=False))
            owner = np.concatenate([lines, wrapped, whole])
            some, dot, which, known, r, word, times, dictionary = scorer.products(
                pa.concat_arrays([pc.list_flatten(statements), over, text.take(pa.array(whole))]), owner, text)
            others = np.bincount(r, weights=times.astype(float) ** 2, minlength=len(some))
            high, low = dot / np.sqrt(known + others), dot / np.sqrt(known + others * rarest ** 2)
            bar = np.full(len(text), least)
            np.maximum.at(bar, owner[some], low)
            kept = np.flatnonzero(high >= bar[owner[some]] - 1e-9)
            kept = kept[np.argsort(owner[some[kept]], kind="stable")]
            upto = np.searchsorted(owner[some[kept]], np.arange(len(text) + 1))
            a, z = np.searchsorted(r, kept), np.searchsorted(r, kept, side="right")
            at = np.concatenate([np.zeros(0, np.int64), *map(np.arange, a.tolist(), z.tolist())])
            word_upto = pa.array(np.concatenate([[0], np.cumsum(z - a)]).astype(np.int32))
            candidates = pa.StructArray.from_arrays(
                [pa.array(which[kept].astype(np.int64)), pa.array(dot[kept]), pa.array(known[kept]),
                 pa.ListArray.from_arrays(word_upto, pa.StructArray.from_arrays(
                     [dictionary.take(pa.array(word[at])).cast(pa.string()), pa.array(times[at].astype(np.int64))], names=["term", "times"]))],
                names=["which", "dot", "known", "others"])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(number, number + len(text))), *[part.column(c) for c in ("doc_id", "path", "licence_file")],
                 pa.ListArray.from_arrays(pa.array(upto.astype(np.int32)), candidates)],
                names=["number", "doc_id", "path", "licence_file", "candidates"])
            number += len(text)


_SCORED = ("number long, doc_id long, path string, licence_file boolean, "
           "candidates array<struct<which: long, dot: double, known: double, others: array<struct<term: string, times: long>>>>")


def _own(rows: DataFrame, min_cosine: float) -> DataFrame:
    """``doc_id``, ``path``, ``licence_file`` and each row's own ``licence`` and ``score`` (null and 0 if none)."""
    counted = frequencies(rows)
    terms, idf, total = weights(counted)
    files = stored(rows.mapInArrow(on_workers(__name__, "_score_batches", terms, idf, float(1 + np.log(1 + total)), min_cosine), _SCORED),
                   "licence-candidates")
    candidates = files.select("number", F.posexplode("candidates").alias("at", "c"))
    others = candidates.select("number", "at", F.explode("c.others").alias("o")).select("number", "at", "o.term", "o.times")
    used = others.select("term").distinct().join(counted, "term").select(
        "term", (1 + F.log((1 + F.lit(total)) / (1 + F.col("files")))).alias("idf"))
    squares = (others.join(bounded_broadcast(stored(used, "other-words"), MAX_WORDS), "term")
               .groupBy("number", "at").agg(F.sum(F.pow(F.col("idf") * F.col("times"), F.lit(2))).alias("_others")))
    cosine = F.col("c.dot") / F.sqrt(F.col("c.known") + F.coalesce("_others", F.lit(0.0)))
    best = (candidates.join(squares, ["number", "at"], "left").select("number", cosine.alias("cosine"), (-F.col("c.which")).alias("which"))
            .where(F.col("cosine") >= min_cosine).groupBy("number").agg(F.max(F.struct("cosine", "which")).alias("_best")))
    names = F.array(*[F.lit(n) for n, _ in TEMPLATES])
    return files.join(best, "number", "left").select(
        "doc_id", "path", "licence_file", F.get(names, (-F.col("_best.which")).cast("int")).alias("licence"),
        F.coalesce(F.least(F.col("_best.cosine"), F.lit(1.0)), F.lit(0.0)).alias("score"))


def _directory(path: Column) -> Column:
    """The part of ``path`` before its last slash; empty at the top."""
    return F.regexp_replace(F.regexp_extract(path, r"(?s)^(.*)/[^/]*$", 1), "/+$", "")


def licences(files: DataFrame, min_cosine: float = MIN_COSINE) -> DataFrame:
    """Licence of every row of ``files`` (``doc_id``, ``path``, ``text``; other columns are not read).

    Returns ``doc_id``, ``path``, ``licence`` (null if none), ``score`` (cosine
    of the statement found, or of the licence file's one that is inherited; 0
    if none), ``how`` (``own``, ``inherited`` or ``none``) and ``licence_dir``
    (the directory inherited from).

    A directory's licence is that of its licence file with the highest score
    (ties: the smallest name). A file with a statement of its own inherits
    nothing. A null text has no statement; a null path has no directory and
    inherits nothing; paths may repeat. Words compare in lower case. Texts are
    read whole. An empty table gives no rows.
    """
    rows = files.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("path").cast("string").alias("path"),
                        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    name = F.regexp_extract("path", r"([^/]*)$", 1)
    rows = rows.withColumn("licence_file", F.coalesce(name.rlike(LICENCE_FILE), F.lit(False)))
    own = stored(_own(rows, min_cosine).withColumn("directory", _directory(F.col("path"))), "licences")

    at = (own.where("licence_file and licence is not null and directory is not null").groupBy("directory")
          .agg(F.min(F.struct((-F.col("score")).alias("s"), F.col("licence").alias("licence"))).alias("_b"))
          .select(F.col("directory").alias("licence_dir"), F.col("_b.licence").alias("_licence"), (-F.col("_b.s")).alias("_score")))
    at = bounded_broadcast(stored(at, "licence-directories"), MAX_DIRECTORIES)
    # Every directory that needs one, with its ancestors, nearest first.
    needy = own.where("licence is null and directory is not null").select("directory").distinct()
    steps = F.split("directory", "/")
    ancestors = needy.select("directory", F.explode(F.sequence(F.lit(0), F.when(F.col("directory") == "", 0).otherwise(F.size(steps)))).alias("depth"))
    ancestors = ancestors.withColumn("licence_dir", F.when(F.col("depth") == 0, "").otherwise(F.expr("substring_index(directory, '/', depth)")))
    nearest = (ancestors.join(at, "licence_dir").groupBy("directory")
               .agg(F.max(F.struct("depth", "licence_dir", "_licence", "_score")).alias("_n"))
               .select(F.col("directory").alias("_directory"), "_n.licence_dir", "_n._licence", "_n._score"))
    nearest = bounded_broadcast(stored(nearest, "nearest-licences"), MAX_DIRECTORIES)
    joined = own.join(nearest, F.col("licence").isNull() & (F.col("directory") == F.col("_directory")), "left")
    return joined.select("doc_id", "path", F.coalesce("licence", "_licence").alias("licence"),
                         F.when(F.col("licence").isNull(), F.coalesce("_score", F.lit(0.0))).otherwise(F.col("score")).alias("score"),
                         F.when(F.col("licence").isNotNull(), "own").when(F.col("_licence").isNotNull(), "inherited").otherwise("none").alias("how"),
                         F.when(F.col("licence").isNull(), F.col("licence_dir")).alias("licence_dir"))


def standin_paths(documents: DataFrame) -> DataFrame:
    """Documents as files of a tree: ``source``/``lang``/shelf of the doc_id; every eleventh one is
    named as a licence file, in its shelf or higher up. Gives paths only."""
    number, folder = F.col("doc_id"), F.concat_ws("/", "source", "lang")
    shelf = F.concat_ws("/", folder, F.concat(F.lit("shelf"), (number % 500).cast("string")))
    licence = F.concat(F.lit("LICENSE-"), number.cast("string"), F.lit(".txt"))
    path = (F.when(number % 1331 == 0, F.concat_ws("/", "source", licence)).when(number % 121 == 0, F.concat_ws("/", folder, licence))
            .when(number % 11 == 0, F.concat_ws("/", shelf, licence))
            .otherwise(F.concat_ws("/", shelf, F.concat(number.cast("string"), F.lit(".txt")))))
    return documents.select("doc_id", "text", path.alias("path"))
