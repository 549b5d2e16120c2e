"""Language identification by word-first backoff.

The model is counted from labelled documents, all of them: word counts and
character n-gram counts per language, summed in Spark.  A word is a run of
letters in lower case.  A known word adds its log frequency in each language;
an unseen word backs off to its character n-grams of the longest length that
has a known one, then to shorter ones.

The counts stay whole, as Spark tables.  The ``words`` most frequent words and
the ``grams`` most frequent n-grams of each length travel to the scorers as a
cache; every other word of a text is looked up in the tables by a join, and
every other n-gram of an unseen word likewise, so the sizes of the cache change
the cost and not the result.  Log frequencies are integers (units of
1/``UNIT``), so sums do not depend on their order.

The frequency of a word in a language is its count over the language's total
plus the number of distinct words of all languages; to each, one common amount
is added (an occurrence in the language with the most text).  So a word that a
language has not seen weighs the same in all of them, and always less than one
it has seen.

The score is the posterior of the best language at equal priors, per word (the
geometric mean over the words), so that it does not saturate with length.

Defined results: a null text, an empty one, or one without a letter is ``und``
with score 0; ties go to the first language by name; rows with a null language
teach nothing; without any labelled row every text is ``und``; rows that
repeat a ``doc_id`` are scored one by one; no rows give no rows; further
columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import reduce
from math import log

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dichot.llm.spark import ready, written
from dichot.llm.text import slices

WORDS = 100_000
GRAMS = 50_000
LONGEST = 4
UNKNOWN = "und"
#: log frequencies are multiples of 1 / UNIT
UNIT = 10**8
_LETTERS = regex.compile(r"\p{L}+")


def _words(text: str | None) -> list[str]:
    return _LETTERS.findall(text.lower()) if text else []


def _grams(word: str, n: int) -> list[str]:
    """The n-grams of a word with its ends marked."""
    told = f"^{word}$"
    return [told[i:i + n] for i in range(len(told) - n + 1)]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Word counts per language of a partition, sent on before they grow large."""
    counts: dict[int, Counter] = {}

    def flush():
        rows = [(lang, w, n) for lang, c in counts.items() for w, n in c.items()]
        counts.clear()
        for i in range(0, len(rows), 50_000):
            lang, word, n = zip(*rows[i:i + 50_000])
            yield pa.RecordBatch.from_arrays([pa.array(lang, pa.int32()), pa.array(word), pa.array(n, pa.int64())], names=["lang", "word", "n"])

    for batch in batches:
        for part in slices(batch, "text"):
            for lang, text in zip(part.column("lang").to_pylist(), part.column("text").to_pylist()):
                counts.setdefault(lang, Counter()).update(_words(text))
            if sum(map(len, counts.values())) > 800_000:
                yield from flush()
    yield from flush()


def _count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: dict[tuple[int, int, str], int] = Counter()

    def flush():
        if counts:
            rows = list(counts.items())
            counts.clear()
            yield pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k, _ in rows], pa.int32()), pa.array([k[1] for k, _ in rows], pa.int32()),
                 pa.array([k[2] for k, _ in rows]), pa.array([n for _, n in rows], pa.int64())], names=["lang", "size", "gram", "n"])

    for batch in batches:
        for word, by_lang in zip(batch.column("word").to_pylist(), batch.column("ns").to_pylist()):
            told = [(lang, n) for lang, n in enumerate(by_lang) if n]
            for size in range(1, LONGEST + 1):
                for gram in _grams(word, size):
                    for lang, n in told:
                        counts[lang, size, gram] += n
            if len(counts) > 400_000:
                yield from flush()
    yield from flush()


class Cache:
    """Log frequencies of the most frequent words and n-grams; fixed in size."""

    def __init__(self, words: list, grams: list, width: int) -> None:
        self.width = width
        self.words = {r["word"]: i for i, r in enumerate(words)}
        self.rows = np.array([r["v"] for r in words], dtype=np.int64).reshape(-1, width)
        self.grams = {(r["size"], r["gram"]): i for i, r in enumerate(grams)}
        self.gram_rows = np.array([r["v"] for r in grams], dtype=np.int64).reshape(-1, width)


class Model:
    """``words`` (``word, n, v``) and ``grams`` (``size, gram, n, v``) hold all that
    was counted, ``v`` with the log frequency in each of ``langs``; ``other`` is
    that of what no language has."""

    def __init__(self, langs: list[str], words: DataFrame | None = None, grams: DataFrame | None = None,
                 other: int = 0, cache: Cache | None = None) -> None:
        self.langs, self.words, self.grams, self.other, self.cache = langs, words, grams, other, cache


def _by_lang(counts: DataFrame, keys: list[str], langs: int) -> DataFrame:
    """``keys, ns``: the counts of every key as an array over the languages."""
    return counts.groupBy(*keys).agg(F.array(*(F.sum(F.when(F.col("lang") == i, F.col("n")).otherwise(0)) for i in range(langs))).alias("ns"))


def _values(table: DataFrame, keys: list[str], at: list[int], totals: list[int], kinds: int) -> tuple[DataFrame, int]:
    """``keys, n, v`` of a table of counts, and the value of a key it lacks."""
    least = 1 / (max(totals) + kinds)
    v = F.array(*(F.round(F.log(F.col("ns")[i] / F.lit(float(n + kinds)) + F.lit(least)) * UNIT).cast("long") for i, n in zip(at, totals)))
    n = sum((F.col("ns")[i] for i in at), F.lit(0).cast("long"))
    return table.select(*keys, n.alias("n"), v.alias("v")), round(log(least) * UNIT)


def train(docs: DataFrame, words: int = WORDS, grams: int = GRAMS) -> Model:
    """Count a model from ``docs`` (``text``, ``lang``); ``words`` and ``grams``
    are the sizes of the cache."""
    ready(docs)
    told = docs.where("lang is not null").select(F.col("lang").cast("string").alias("lang"), "text")
    named = sorted(r["lang"] for r in told.select("lang").distinct().collect())
    if not named:
        return Model([])
    number = F.coalesce(*(F.when(F.col("lang") == x, F.lit(i)) for i, x in enumerate(named)))
    counted = written(_by_lang(told.select(number.alias("lang"), "text").mapInArrow(_count, "lang int, word string, n long"),
                               ["word"], len(named)), "langid-words")

    def sums(table):
        return [F.sum(F.col("ns")[i]).alias(f"n{i}") for i in range(len(named))], F.count("*").alias("kinds")

    each, kinds = sums(counted)
    total = counted.agg(*each, kinds).first()
    at = [i for i in range(len(named)) if total[f"n{i}"]]
    if not at:
        return Model([])
    values, other = _values(counted, ["word"], at, [total[f"n{i}"] for i in at], total["kinds"])
    pieces = written(_by_lang(counted.mapInArrow(_count_grams, "lang int, size int, gram string, n long"), ["size", "gram"], len(named)),
                     "langid-grams")
    each, kinds = sums(pieces)
    sizes = {r["size"]: r for r in pieces.groupBy("size").agg(*each, kinds).collect()}
    tables = {s: _values(pieces.where(F.col("size") == s), ["size", "gram"], at, [r[f"n{i}"] for i in at], r["kinds"])[0]
              for s, r in sizes.items()}
    top = [r for t in tables.values() for r in t.orderBy(F.desc("n"), "gram").limit(grams).collect()]
    cache = Cache(values.orderBy(F.desc("n"), "word").limit(words).collect(), top, len(at))
    return Model([named[i] for i in at], values, reduce(DataFrame.unionByName, tables.values()), other, cache)


def _sums(column: str, width: int, times: F.Column | None = None) -> F.Column:
    """The sums of an array of longs over the rows of a group."""
    return F.array(*(F.sum(F.col(column)[i] if times is None else F.col(column)[i] * times) for i in range(width)))


def _lists(lists: list[list[str]]) -> tuple[pa.Array, pa.Array]:
    at = np.cumsum([0, *map(len, lists)])
    return pa.array(at, pa.int32()), pa.array([x for part in lists for x in part], pa.string())


def _unseen_values(words: DataFrame, model: Model, shared) -> DataFrame:
    """``word, v`` of words that no language has, by their n-grams; a word
    without any known n-gram is not among them."""
    width = len(model.langs)

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = shared.value
        for batch in batches:
            names, sizes, hits, totals, rest = [], [], [], [], []
            for word in batch.column("word").to_pylist():
                for size in range(LONGEST, 0, -1):
                    all_grams = _grams(word, size)
                    known = [cache.grams[size, g] for g in all_grams if (size, g) in cache.grams]
                    names.append(word)
                    sizes.append(size)
                    hits.append(len(known))
                    totals.append(cache.gram_rows[known].sum(axis=0).tolist() if known else [0] * width)
                    rest.append([g for g in all_grams if (size, g) not in cache.grams])
                    if known:  # shorter n-grams cannot count any more
                        break
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, pa.string()), pa.array(sizes, pa.int32()), pa.array(hits, pa.int64()),
                 pa.array(totals, pa.list_(pa.int64())), pa.ListArray.from_arrays(*_lists(rest))], names=["word", "size", "hits", "v", "rest"])

    first = written(words.mapInArrow(look_up, "word string, size int, hits long, v array<long>, rest array<string>"), "langid-unseen")
    more = first.select("word", "size", F.explode("rest").alias("gram")).join(model.grams, ["size", "gram"])
    found = (first.select("word", "size", "hits", "v").unionByName(more.select("word", "size", F.lit(1).cast("long").alias("hits"), "v"))
             .groupBy("word", "size").agg(F.sum("hits").alias("hits"), _sums("v", width).alias("v")).where("hits > 0"))
    best = found.groupBy("word").agg(F.max(F.struct("size", "hits", "v")).alias("x"))
    return best.select("word", F.expr("transform(x.v, s -> s div x.hits)").alias("v"))


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, lang_pred, score`` for every row of ``docs`` (``doc_id, text``)."""
    spark = ready(docs)
    told = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    if not model.langs:
        return told.select("doc_id", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    width, langs = len(model.langs), model.langs
    # a table of fixed size: at most words + LONGEST * grams rows
    shared = spark.sparkContext.broadcast(model.cache)

    def known(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = shared.value
        for batch in batches:
            for part in slices(batch, "text"):
                counts, sums, rest = [], [], []
                for text in part.column("text").to_pylist():
                    words = _words(text)
                    at = np.fromiter((cache.words.get(w, -1) for w in words), dtype=np.int64, count=len(words))
                    counts.append(len(words))
                    sums.append(cache.rows[at[at >= 0]].sum(axis=0))
                    rest.append(Counter(words[i] for i in np.flatnonzero(at < 0)))
                ends, names = _lists([list(c) for c in rest])
                times = pa.array([n for c in rest for n in c.values()], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [part.column("row"), part.column("doc_id"), pa.array(counts, pa.int64()),
                     pa.array([x.tolist() for x in sums], pa.list_(pa.int64())),
                     pa.ListArray.from_arrays(ends, pa.StructArray.from_arrays([names, times], names=["word", "n"]))],
                    names=["row", "doc_id", "n_words", "v", "rest"])

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = batch.column("n_words").to_numpy()
            mean = np.array(batch.column("v").to_pylist(), dtype=np.float64).reshape(-1, width) / UNIT / np.maximum(counts, 1)[:, None]
            odds = np.exp(mean - mean.max(axis=1, keepdims=True))
            best = mean.argmax(axis=1)
            told = counts > 0
            names = [langs[i] if t else UNKNOWN for i, t in zip(best, told)]
            score = np.where(told, odds.max(axis=1) / odds.sum(axis=1), 0.0)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(names, pa.string()), pa.array(score, pa.float64())],
                                             names=["doc_id", "lang_pred", "score"])

    first = written(told.withColumn("row", F.monotonically_increasing_id()).mapInArrow(
        known, "row long, doc_id long, n_words long, v array<long>, rest array<struct<word: string, n: long>>"), "langid-known")
    rare = first.select("row", F.explode("rest").alias("r")).select("row", "r.word", "r.n")
    asked = written(rare.select("word").distinct().join(model.words.select("word", "v"), "word", "left"), "langid-asked")
    values = asked.where("v is not null").unionByName(_unseen_values(asked.where("v is null").select("word"), model, shared))
    v = F.coalesce(F.col("v"), F.array(*[F.lit(model.other).cast("long")] * width))
    more = (rare.join(values, "word", "left").select("row", "n", v.alias("v"))
            .groupBy("row").agg(_sums("v", width, F.col("n")).alias("more")))
    whole = first.select("row", "doc_id", "n_words", "v").join(more, "row", "left")
    added = F.when(F.col("more").isNull(), F.col("v")).otherwise(F.zip_with("v", "more", lambda a, b: a + b))
    return whole.select("doc_id", "n_words", added.alias("v")).mapInArrow(decide, "doc_id long, lang_pred string, score double")
