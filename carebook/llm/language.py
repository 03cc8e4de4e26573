"""Language identification by character language models with Kneser-Ney smoothing.

Training: one pass counts, per language, every run of ``ORDER`` characters
inside words (with marks for a word's start and end); the counts are summed
over the whole corpus by Spark. From them the driver compiles interpolated
Kneser-Ney models: absolute discounting at the highest order, continuation
counts below, down to single characters and a uniform floor. Models are kept
in sorted hash arrays: hash of the run, and its log-probability in every
language. Where there are more runs than one array should hold, the same models
stay tables: the runs of the corpus' distinct words are joined with them, and texts
with the scores of their words. A text's cross-entropy in a language is its mean negative
log-probability a character; the lowest one names the language.

Rejection is calibrated on the training texts by medians, so that no few texts
set it, however long: per language, the median cross-entropy, its spread between
texts (from the longer half of them) and its variance for one symbol (from the
shorter half). A text is rejected if its cross-entropy in the named language
lies above the median by more than ``sigmas`` standard deviations at its
length, or if it has no letters.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carebook.llm.common import on_workers, rows_without, stored, text_key
from carebook.llm.tokenizing import slices
from carebook.llm.worker_memory import drop_kept, release
from carebook.operators.broadcast import bounded_broadcast

ORDER = 4
MAX_RUNS = 2_000_000
MAX_LANGUAGES = 400
REJECT_SIGMAS = 8.0
LEAST_SIGMA = 0.05  # nats a symbol; texts of one language differ that much at any length
NORMAL_MAD = 0.6745  # median absolute deviation of a normal variable of variance 1
UNDETERMINED = "und"
_START, _END = 2, 3  # marks of a word's start and end; not letters
_NOT_LETTERS = r"[^\p{L}\p{M}]+"
_LETTER = r"\p{L}"
_P = np.uint64(0x9E3779B97F4A7C15)
SLICE = 4 << 20


# ---- runs of characters -----------------------------------------------------

def _words(texts: pa.Array) -> tuple[np.ndarray, pa.DictionaryArray]:
    """Offsets of each text's words, and the words, lower-cased."""
    lists = pc.split_pattern_regex(pc.utf8_lower(texts.cast(pa.string()).fill_null("")), _NOT_LETTERS)
    offsets = lists.offsets.to_numpy().astype(np.int64)
    return offsets - offsets[0], pc.list_flatten(lists).dictionary_encode()


def _symbols(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all words, each after ORDER - 1 start marks and before an
    end mark; and where each word's first letter stands."""
    pad = chr(_START) * (ORDER - 1)
    joined = "".join(f"{pad}{w}{chr(_END)}" for w in words)
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + ORDER
    return codes, np.cumsum(lengths) - lengths + ORDER - 1


def _run_hashes(codes: np.ndarray, size: int) -> np.ndarray:
    """Hash of the ``size`` symbols that end at each position (the first size - 1 are not used)."""
    out = np.zeros(len(codes), np.uint64)
    with np.errstate(over="ignore"):
        for back in range(size - 1, -1, -1):
            out[size - 1:] = (out[size - 1:] + codes[size - 1 - back:len(codes) - back].astype(np.uint64) + np.uint64(1)) * _P
            out ^= out >> np.uint64(29)
    return out


def _predicted(n: int, firsts: np.ndarray) -> np.ndarray:
    """Positions that are predicted: all but the start marks."""
    keep = np.ones(n, bool)
    for back in range(1, ORDER):
        keep[firsts - back] = False
    return np.flatnonzero(keep)


def _count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    drop_kept()
    for batch in batches:
        for part in slices(batch, "text", SLICE):
            release()
            offsets, words = _words(part.column("text"))
            names = part.column("lang").dictionary_encode()
            lang = np.repeat(names.indices.to_numpy(), np.diff(offsets))
            vocabulary = words.dictionary.to_pylist()
            index = words.indices.to_numpy()
            times = np.bincount(lang * len(vocabulary) + index, minlength=len(names.dictionary) * len(vocabulary)).reshape(-1, max(1, len(vocabulary)))
            codes, firsts = _symbols(vocabulary)
            ends = _predicted(len(codes), firsts)
            # An empty word comes from white space at a text's ends; it has no letters.
            empty = np.fromiter((not w for w in vocabulary), bool, len(vocabulary))
            owner = np.searchsorted(firsts, ends, side="right") - 1
            owner_empty = empty[owner]
            ends, owner = ends[~owner_empty], owner[~owner_empty]
            if not len(ends):
                continue
            _, sample, run = np.unique(_run_hashes(codes, ORDER)[ends], return_index=True, return_inverse=True)
            runs = np.stack([codes[ends[sample] - back] for back in range(ORDER - 1, -1, -1)], axis=1)
            texts = runs.astype("<u4").tobytes().decode("utf-32-le", "surrogatepass")
            texts = [texts[i:i + ORDER] for i in range(0, len(texts), ORDER)]
            for name, per_word in zip(names.dictionary.to_pylist(), times):
                n = np.bincount(run, weights=per_word[owner], minlength=len(texts)).astype(np.int64)
                seen = np.flatnonzero(n)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * len(seen), pa.string()), pa.array([texts[i] for i in seen.tolist()], pa.string()), pa.array(n[seen])],
                    names=["lang", "run", "n"])


def run_counts(labelled: DataFrame) -> DataFrame:
    """(lang, run, n): how often each run of ORDER characters occurs in each language's texts."""
    rows = labelled.where("lang is not null and text is not null").select(
        F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    return (rows.mapInArrow(on_workers(__name__, "_count_batches"), "lang string, run string, n long")
            .groupBy("lang", "run").agg(F.sum("n").alias("n")))


# ---- the model --------------------------------------------------------------

def _hash_texts(texts: list[str]) -> np.ndarray:
    """Hashes of equal-length strings."""
    if not texts:
        return np.zeros(0, np.uint64)
    size = len(texts[0])
    codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    return _run_hashes(codes, size)[size - 1::size]


def _lookup(keys: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Place of each wanted hash in the sorted ``keys``; -1 if it is not there."""
    if not len(keys):
        return np.full(len(wanted), -1)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, at, -1)


def compile_model(languages: list[str], lang: np.ndarray, runs: list[str], n: np.ndarray) -> dict:
    """Sorted hash arrays of the interpolated Kneser-Ney models of all languages.

    For each order k: ``gram[k]`` hashes and the discounted share of a run given
    its context, ``context[k]`` hashes and the weight that goes to the order
    below. ``full`` has the finished log-probabilities of the runs seen.
    """
    size = len(languages)
    orders, count = {}, {}
    for i in range(size):
        count[i] = {runs[j]: int(n[j]) for j in np.flatnonzero(lang == i).tolist()}
    symbols = {r[-1] for r in runs}
    for k in range(ORDER, 0, -1):
        grams = sorted(set().union(*count.values())) if count else []
        contexts = sorted({g[:-1] for g in grams})
        row, crow = {g: i for i, g in enumerate(grams)}, {c: i for i, c in enumerate(contexts)}
        share = np.zeros((len(grams), size), np.float32)
        weight = np.ones((len(contexts), size), np.float32)
        lower: dict[int, dict] = {}
        for i in range(size):
            own = count[i]
            once, twice = sum(v == 1 for v in own.values()), sum(v == 2 for v in own.values())
            discount = once / (once + 2 * twice) if once and twice else 0.5
            total: dict[str, int] = {}
            kinds: dict[str, int] = {}
            down: dict[str, int] = {}
            for g, v in own.items():
                total[g[:-1]] = total.get(g[:-1], 0) + v
                kinds[g[:-1]] = kinds.get(g[:-1], 0) + 1
                down[g[1:]] = down.get(g[1:], 0) + 1
            for g, v in own.items():
                share[row[g], i] = (v - discount) / total[g[:-1]]
            for c, v in total.items():
                weight[crow[c], i] = discount * kinds[c] / v
            lower[i] = down
        gram_hash, context_hash = _hash_texts(grams), (_hash_texts(contexts) if k > 1 else np.zeros(len(contexts), np.uint64))
        a, b = np.argsort(gram_hash), np.argsort(context_hash)
        orders[k] = (gram_hash[a], share[a], context_hash[b], weight[b])
        count = lower
    model = {"languages": languages, "orders": orders, "floor": 1.0 / (len(symbols) + 1), "full": None}
    top = sorted(set(runs))
    keys = _hash_texts(top)
    order = np.argsort(keys)
    codes = np.frombuffer("".join(top[i] for i in order.tolist()).encode("utf-32-le", "surrogatepass"), np.uint32)
    model["full"] = (keys[order], _log_probabilities(model, codes, np.arange(ORDER - 1, len(codes), ORDER)))
    return model


def _log_probabilities(model: dict, codes: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """log P of the symbol at each of ``ends`` given the ORDER - 1 before it, in each language."""
    p = np.full((len(ends), len(model["languages"])), model["floor"], np.float64)
    for k in range(1, ORDER + 1):
        grams = _run_hashes(codes, k)[ends]
        contexts = _run_hashes(codes, k - 1)[ends - 1] if k > 1 else np.zeros(len(ends), np.uint64)
        gram_keys, share, context_keys, weight = model["orders"][k]
        gram, context = _lookup(gram_keys, grams), _lookup(context_keys, contexts)
        p = np.where((context >= 0)[:, None], p * weight[context], p) if len(weight) else p
        if len(share):
            p += np.where((gram >= 0)[:, None], share[gram], 0.0)
    return np.log(p).astype(np.float32)


def _order_table(level: DataFrame, k: int, languages: list[str]) -> tuple[DataFrame, DataFrame]:
    """Of order ``k``, from all of its counts (lang, run, n): (run, ``shares``), the discounted share
    of each run, and (context, ``weights``), the weight that goes to the order below, in every language."""
    ones, twos = F.sum((F.col("n") == 1).cast("long")), F.sum((F.col("n") == 2).cast("long"))
    discounts = bounded_broadcast(level.groupBy("lang").agg(ones.alias("_ones"), twos.alias("_twos")).select(
        "lang", F.when((F.col("_ones") > 0) & (F.col("_twos") > 0), F.col("_ones") / (F.col("_ones") + 2 * F.col("_twos")))
        .otherwise(0.5).alias("discount")), MAX_LANGUAGES)
    runs = level.withColumn("context", F.substring("run", 1, k - 1)).join(discounts, "lang")
    contexts = runs.groupBy("lang", "context", "discount").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("kinds"))
    shares = runs.join(contexts.select("lang", "context", "total"), ["lang", "context"]).select(
        "run", "lang", ((F.col("n") - F.col("discount")) / F.col("total")).alias("value"))
    weights = contexts.select("context", "lang", (F.col("discount") * F.col("kinds") / F.col("total")).alias("value"))

    def by_language(rows: DataFrame, key: str, missing: float, name: str) -> DataFrame:
        own = F.map_from_entries(F.collect_list(F.struct("lang", "value")))
        names = F.array(*[F.lit(x) for x in languages])
        filled = F.transform(names, lambda x: F.coalesce(F.try_element_at(F.col("_own"), x), F.lit(missing)))
        return stored(rows.groupBy(key).agg(own.alias("_own")).select(key, filled.alias(name)), "language-order")

    return by_language(shares, "run", 0.0, "shares"), by_language(weights, "context", 1.0, "weights")


def _fit_tables(counts: DataFrame, languages: list[str]) -> dict:
    """The model that ``compile_model`` gives of all ``counts``, as two tables an order; nothing of it is gathered."""
    symbols = counts.select(F.substring("run", -1, 1)).distinct().count()
    level, tables = counts, {}
    for k in range(ORDER, 0, -1):
        tables[k] = _order_table(level, k, languages)
        if k > 1:
            level = stored(level.groupBy("lang", F.substring("run", 2, k - 1).alias("run")).agg(F.count(F.lit(1)).alias("n")), "lower-runs")
    return {"languages": languages, "floor": 1.0 / (symbols + 1), "tables": tables}


def fit(labelled: DataFrame, max_runs: int = MAX_RUNS) -> dict:
    """Model of every language in ``labelled`` (``lang``, ``text``; rows with a null are left out).

    Counts cover all rows and the model holds all runs. With more than
    ``max_runs`` of them (counted per language) it stays in Spark, in ``tables``;
    probabilities are the same. So what the driver gathers, and broadcasts, is
    bounded, however large the corpus; at
    most ``MAX_LANGUAGES`` languages are allowed. Without any labelled row the
    model is empty.
    """
    counts = stored(run_counts(labelled), "runs")
    languages = [r[0] for r in counts.select("lang").distinct().orderBy("lang").limit(MAX_LANGUAGES + 1).collect()]
    if len(languages) > MAX_LANGUAGES:
        raise ValueError("too many languages for one model")
    if counts.count() > max_runs:
        return _fit_tables(counts, languages)
    rows = counts.toArrow()
    lang = pc.index_in(rows.column("lang"), value_set=pa.array(languages, pa.string())).to_numpy().astype(np.int64)
    return compile_model(languages, lang, rows.column("run").to_pylist(), rows.column("n").to_numpy())


# ---- scoring ----------------------------------------------------------------

class _Scorer:
    """Scores texts; keeps the scores of at most ``max_kept`` words."""

    def __init__(self, model: dict, max_kept: int = 250_000):
        self.model, self.max_kept = model, max_kept
        self.size = len(model["languages"])
        self.slot: dict[str, int] = {}
        self.kept = np.zeros((0, self.size + 1))

    def _score_words(self, words: list[str]) -> np.ndarray:
        """Sum of log P in each language, and the number of symbols (0 for the empty word)."""
        codes, firsts = _symbols(words)
        ends = _predicted(len(codes), firsts)
        keys, known = self.model["full"]
        at = _lookup(keys, _run_hashes(codes, ORDER)[ends])
        logs = known[at].astype(np.float64) if len(known) else np.zeros((len(ends), self.size))
        new = np.flatnonzero(at < 0)
        if len(new):
            logs[new] = _log_probabilities(self.model, codes, ends[new])
        starts = np.searchsorted(ends, firsts)
        out = np.empty((len(words), self.size + 1))
        out[:, :-1] = np.add.reduceat(logs, starts, axis=0)
        out[:, -1] = np.diff(np.append(starts, len(ends)))
        out[np.fromiter((not w for w in words), bool, len(words))] = 0
        return out

    def entropies(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Cross-entropy of each text in each language, and its number of symbols."""
        offsets, words = _words(texts)
        vocabulary = words.dictionary.to_pylist()
        if not vocabulary:
            return np.zeros((len(texts), self.size)), np.zeros(len(texts))
        place = np.fromiter((self.slot.get(w, -1) for w in vocabulary), np.int64, len(vocabulary))
        new = np.flatnonzero(place < 0)
        table = self.kept
        if len(new):
            table = np.concatenate([self.kept, self._score_words([vocabulary[i] for i in new.tolist()])])
            place[new] = len(self.kept) + np.arange(len(new))
            if len(table) <= self.max_kept:
                self.kept = table
                self.slot.update(zip((vocabulary[i] for i in new.tolist()), place[new].tolist()))
        values = table[place[words.indices.to_numpy()]]
        sums = np.zeros((len(texts), self.size + 1))
        some = np.flatnonzero(np.diff(offsets) > 0)
        if len(some):
            sums[some] = np.add.reduceat(values, offsets[:-1][some], axis=0)
        n = sums[:, -1]
        return -sums[:, :-1] / np.maximum(n, 1)[:, None], n


def _score_batches(batches: Iterator[pa.RecordBatch], shared, carried: list[str]) -> Iterator[pa.RecordBatch]:
    drop_kept()
    model = shared.value
    scorer = _Scorer(model)
    names = pa.array(model["languages"], pa.string())
    for batch in batches:
        for part in slices(batch, "text", SLICE):
            text = part.column("text").cast(pa.string())
            entropy, n = scorer.entropies(text)
            wordless = ~pc.fill_null(pc.match_substring_regex(text, _LETTER), False).to_numpy(zero_copy_only=False)
            blank = wordless.copy()
            if len(names):
                best = entropy.argmin(1)
                least = entropy[np.arange(len(entropy)), best]
                confidence = 1 / np.exp(least[:, None] - entropy).sum(1)
                blank |= n == 0
            else:
                best, least, confidence = np.zeros(len(n), np.int64), np.zeros(len(n)), np.zeros(len(n))
                blank[:] = True
            guess = names.take(pa.array(np.where(blank, 0, best))) if len(names) else pa.nulls(len(n), pa.string())
            yield pa.RecordBatch.from_arrays(
                [*[part.column(c) for c in carried],
                 pc.if_else(pa.array(blank), pa.scalar(UNDETERMINED), guess),
                 pa.array(np.where(blank, 0.0, confidence)),
                 pa.array(np.where(blank, 0.0, least)), pa.array(np.where(blank, 0, n).astype(np.int64)), pa.array(wordless)],
                names=[*carried, "lang_pred", "score", "entropy", "symbols", "wordless"])
            release()


def scored(docs: DataFrame, model: dict) -> DataFrame:
    """``doc_id``, ``text_key``, ``lang`` (as it came) and, of each row, ``lang_pred``, ``score``, ``entropy``, ``symbols``
    and ``wordless`` (null, or without a letter).

    ``score`` (0 to 1) is the share of the named language when each language
    weighs exp(-cross-entropy). Texts that are null or have no letter are
    ``und`` with score 0.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_key(F.col("text").cast("string")).alias("text_key"),
                       F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    if "tables" in model:
        return _scored_by_tables(rows, model)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded: see fit
    return rows.mapInArrow(on_workers(__name__, "_score_batches", shared, ["doc_id", "text_key", "lang"]),
                           "doc_id long, text_key long, lang string, lang_pred string, score double, entropy double, symbols long, wordless boolean")


def _word_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every text, numbered, with its distinct words and how often it has them."""
    from pyspark import TaskContext
    drop_kept()
    number = TaskContext.get().partitionId() << 40
    for batch in batches:
        for part in slices(batch, "text", SLICE):
            release()
            text = part.column("text").cast(pa.string())
            wordless = ~pc.fill_null(pc.match_substring_regex(text, _LETTER), False).to_numpy(zero_copy_only=False)
            offsets, words = _words(text)
            owner = np.repeat(np.arange(len(text)), np.diff(offsets))
            pair, times = np.unique(owner * max(1, len(words.dictionary)) + words.indices.to_numpy(), return_counts=True)
            owner, word = pair // max(1, len(words.dictionary)), pair % max(1, len(words.dictionary))
            upto = np.searchsorted(owner, np.arange(len(text) + 1)).astype(np.int32)
            held = pa.StructArray.from_arrays([words.dictionary.take(pa.array(word)).cast(pa.string()), pa.array(times.astype(np.int64))], names=["word", "times"])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(number, number + len(text))), *[part.column(c) for c in ("doc_id", "text_key", "lang")], pa.array(wordless),
                 pa.ListArray.from_arrays(pa.array(upto), held)], names=["row", "doc_id", "text_key", "lang", "wordless", "words"])
            number += len(text)


def _run_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(w1, w2, run, n): the runs of every word, under the word's hashes."""
    for batch in batches:
        for part in slices(batch, "word", SLICE):
            codes, firsts = _symbols(part.column("word").to_pylist())
            ends = _predicted(len(codes), firsts)
            owner = np.searchsorted(firsts, ends, side="right") - 1
            _, sample, run = np.unique(_run_hashes(codes, ORDER)[ends], return_index=True, return_inverse=True)
            runs = np.stack([codes[ends[sample] - back] for back in range(ORDER - 1, -1, -1)], axis=1).astype("<u4").tobytes().decode("utf-32-le", "surrogatepass")
            texts = pa.array([runs[i:i + ORDER] for i in range(0, len(runs), ORDER)], pa.string())
            pair, n = np.unique(owner * max(1, len(sample)) + run.reshape(-1), return_counts=True)
            word, run = pa.array(pair // max(1, len(sample))), pa.array(pair % max(1, len(sample)))
            yield pa.RecordBatch.from_arrays([part.column("w1").take(word), part.column("w2").take(word), texts.take(run), pa.array(n.astype(np.int64))],
                                             names=["w1", "w2", "run", "n"])


def _sums(values: str, times: Column, size: int) -> Column:
    """Element by element sums of the arrays in ``values``, each ``times``."""
    return F.array(*[F.sum(F.col(values)[i] * times) for i in range(size)])


def _scored_by_tables(rows: DataFrame, model: dict) -> DataFrame:
    """``scored`` with a model in tables: every distinct run is scored once, then every distinct word, then texts.

    Joins are on runs and on words' hashes (two of 64 bits); a frequent run or word
    meets one row of the other side, so Spark's skew split cuts it. Nothing is
    broadcast by hand.
    """
    size = len(model["languages"])
    texts = stored(rows.mapInArrow(on_workers(__name__, "_word_batches"),
                                   "row long, doc_id long, text_key long, lang string, wordless boolean, words array<struct<word: string, times: long>>"), "text-words")
    ids = [F.xxhash64("word").alias("w1"), F.xxhash64("word", F.lit(1)).alias("w2")]
    pairs = texts.select("row", F.explode("words").alias("_w")).select("row", "_w.word", "_w.times").where("word <> ''")
    words = pairs.select("word").distinct().select("word", *ids)
    runs = stored(words.mapInArrow(on_workers(__name__, "_run_batches"), "w1 long, w2 long, run string, n long"), "word-runs")
    below = None
    for k in range(1, ORDER + 1):
        shares, weights = model["tables"][k]
        need = runs.select(F.substring("run", ORDER + 1 - k, k).alias("run")).distinct().withColumns(
            {"context": F.substring("run", 1, k - 1), "lower": F.substring("run", 2, k - 1)})
        found = need.join(shares, "run", "left").join(weights, "context", "left")
        p = F.array_repeat(F.lit(model["floor"]), size)
        if below is not None:
            found, p = found.join(below, "lower"), F.col("p")
        p = F.zip_with(p, F.coalesce("weights", F.array_repeat(F.lit(1.0), size)), lambda a, b: a * b)
        p = F.zip_with(p, F.coalesce("shares", F.array_repeat(F.lit(0.0), size)), lambda a, b: a + b)
        scores = stored(found.select("run", p.alias("p")), "run-scores")
        below = scores.withColumnRenamed("run", "lower")
    logs = scores.select("run", F.transform("p", lambda x: F.log(x)).alias("logs"))
    by_word = stored(runs.join(logs, "run").groupBy("w1", "w2").agg(_sums("logs", F.col("n"), size).alias("logs"), F.sum("n").alias("symbols")), "word-scores")
    by_text = pairs.select("row", "times", *ids).join(by_word, ["w1", "w2"]).groupBy("row").agg(
        _sums("logs", F.col("times"), size).alias("logs"), F.sum(F.col("symbols") * F.col("times")).alias("n"))
    told = texts.drop("words").join(by_text, "row", "left")
    entropy = F.transform("logs", lambda x: -x / F.col("n"))
    told = told.withColumn("entropies", entropy).withColumn("least", F.array_min("entropies"))
    blank = F.col("wordless") | F.col("n").isNull()
    names = F.array(*[F.lit(x) for x in model["languages"]])
    share = 1 / F.aggregate("entropies", F.lit(0.0), lambda a, e: a + F.exp(F.col("least") - e))
    return told.select("doc_id", "text_key", "lang",
                       F.when(blank, UNDETERMINED).otherwise(names[F.array_position("entropies", F.col("least")).cast("int") - 1]).alias("lang_pred"),
                       F.when(blank, 0.0).otherwise(share).alias("score"), F.when(blank, 0.0).otherwise(F.col("least")).alias("entropy"),
                       F.when(blank, 0).otherwise(F.col("n")).cast("long").alias("symbols"), "wordless")


def _median(column: Column) -> Column:
    return F.percentile_approx(column, 0.5, 10_000)


def calibrated(scores: DataFrame, training: Column, sigmas: float = REJECT_SIGMAS) -> DataFrame:
    """``scores`` with ``rejected``; one row per language is gathered from the distinct training texts.

    Copies of a text count once, so a text that fills much of the table does not
    set the limit for others. A language without a training text rejects nothing.
    """
    n, h = F.col("symbols").cast("double"), F.col("entropy")
    texts = stored(scores.where(training & (F.col("symbols") > 0)).groupBy("lang_pred", "text_key").agg(
        F.min("symbols").alias("symbols"), F.min("entropy").alias("entropy")), "training-texts")
    middle = bounded_broadcast(stored(texts.groupBy("lang_pred").agg(_median(h).alias("_mean"), _median(n).alias("_half")), "medians"), MAX_LANGUAGES)
    away = F.abs(h - F.col("_mean"))
    levels = texts.join(middle, "lang_pred").groupBy("lang_pred").agg(
        F.first("_mean").alias("_mean"),
        (_median(F.when(n >= F.col("_half"), away)) / NORMAL_MAD).alias("_between"),
        (_median(F.when(n <= F.col("_half"), n * away * away)) / NORMAL_MAD ** 2).alias("_variance"))
    sigma = F.sqrt(F.greatest(F.pow("_between", F.lit(2)), F.lit(LEAST_SIGMA ** 2)) + F.col("_variance") / n)
    far = h > F.col("_mean") + sigmas * sigma
    return (scores.join(bounded_broadcast(levels, MAX_LANGUAGES), "lang_pred", "left")
            .withColumn("rejected", F.when(F.col("lang_pred") == UNDETERMINED, F.col("wordless")).otherwise(F.coalesce(far, F.lit(False))))
            .drop("_mean", "_between", "_variance", "wordless"))


def held_out(doc_id: Column) -> Column:
    """A third of the documents, by the CRC-32 of the doc_id as text; a null doc_id is not in it."""
    return F.coalesce(F.crc32(doc_id.cast("long").cast("string").cast("binary")) % 3 == 1, F.lit(False))


def identify(docs: DataFrame, sigmas: float = REJECT_SIGMAS) -> DataFrame:
    """Language of every row of ``docs`` (``doc_id``, ``text``, ``lang``).

    Models and calibration come from the rows that are not held out and have a
    ``lang``; a prediction uses the text alone. Returns ``doc_id``, ``text_key``,
    ``held_out``, ``lang_pred``, ``score`` (0 to 1), ``entropy``, ``symbols``
    and ``rejected``. Null texts and texts without a letter are ``und`` with
    score 0 and rejected. Without any labelled row there is no language to name:
    every text is ``und`` with score 0, and those with letters are not rejected, so
    a table that nobody labelled passes through unjudged. Calibration
    takes the distinct texts of labelled rows whose language was named rightly. Ties go to
    the alphabetically first language. Repeated rows are each scored; very long
    texts are read whole; other columns are not read.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), "lang")
    model = fit(rows.where(~held_out(F.col("doc_id"))))
    scores = stored(scored(rows, model), "languages").withColumn("held_out", held_out(F.col("doc_id")))
    return calibrated(scores, ~F.col("held_out") & F.col("lang").eqNullSafe(F.col("lang_pred")), sigmas).drop("lang")


def accepted(docs: DataFrame, sigmas: float = REJECT_SIGMAS) -> DataFrame:
    """The rows of ``docs`` that ``identify`` does not reject, with their own columns."""
    return rows_without(docs, identify(docs, sigmas).where("rejected"))
