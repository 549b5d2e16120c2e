"""Quality rules with adaptive thresholds.

Every text is measured once (see :func:`measure`).  The measures, as integer
buckets, feed mergeable quantile sketches: counts per (language, source,
measure, bucket).  Sketches of a source merge by addition into those of its
language and of the whole table, so a group with few documents uses the next
larger one.  A bucket is 1/1000 of a share (1/100 of a character for the word
length), which is the sketch's error; ranks are exact and the result does not
depend on partitioning or order.

The threshold of a measure is ``median + reach * max(median - lower quartile,
floor)``: only the lower half of the distribution sets it, so it holds while
under half of a group is junk.  It replaces fixed cut-offs; the table of
thresholds joins back to the documents.

Measures: symbols per word character, repeated lines per line, words in
repeated 8-word windows, words equal to the one before, characters per word.

Defined results: null or empty texts have no words and fail the base rule; a
null language or source is a group of its own; rows that repeat a ``doc_id``
are measured one by one; no rows give no rows; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from dichot.llm.spark import TEXT_ROWS, checked_broadcast, ready, written
from dichot.llm.text import SPACE, Words, slices, spread

SYMBOLS = "[#*$%&|<>]"
REPEAT_WINDOW = 8
MIN_WORDS = 20
REACH = 5
MIN_DOCS = 200
BROADCAST_GROUPS = 1 << 17
#: smallest spread of each measure, in buckets
FLOORS = {"symbols": 20, "lines": 100, "repeats": 50, "same": 50, "length": 200}
TOP_BUCKET = 10_000

_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_BLANK = " \t\n\x0b\x0c\r"
_COLUMNS = "n_words long, word_chars long, n_symbols long, n_lines long, n_dup_lines long, n_repeat_words long, n_same_words long"


def _per_text(flags: np.ndarray, at: np.ndarray) -> np.ndarray:
    total = np.zeros(len(flags) + 1, dtype=np.int64)
    np.cumsum(flags, out=total[1:])
    return total[at[1:]] - total[at[:-1]]


def _measures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text"):
            words = Words(part.column("text"))
            data = words.data
            points = (data & 0xC0) != 0x80
            hashes = words.hashes()
            window, fits = words.windows(hashes, REPEAT_WINDOW)
            at = np.flatnonzero(fits)
            order = np.lexsort((window[at], words.text_of[at]))
            doc, value = words.text_of[at][order], window[at][order]
            equal = (doc[1:] == doc[:-1]) & (value[1:] == value[:-1])
            twice = np.zeros(len(words), dtype=bool)
            twice[at[order[1:][equal]]] = True
            twice[at[order[:-1][equal]]] = True
            same = np.zeros(len(words), dtype=bool)
            same[1:] = (hashes[1:] == hashes[:-1]) & (words.text_of[1:] == words.text_of[:-1])
            lines, repeated = [], []
            for text in part.column("text").to_pylist():
                found = [x for x in (text or "").split("\n") if x.strip(_BLANK)]
                lines.append(len(found))
                repeated.append(len(found) - len(set(found)))
            columns = [words.counts, _per_text(points & ~SPACE[data], words.at), _per_text(_SYMBOL[data], words.at),
                       lines, repeated, _per_text(spread(twice, REPEAT_WINDOW), words.first), _per_text(same, words.first)]
            keys = [part.column(c) for c in ("doc_id", "lang", "source")]
            yield pa.RecordBatch.from_arrays([*keys, *(pa.array(c, pa.int64()) for c in columns)],
                                             names=["doc_id", "lang", "source", *(c.split()[0] for c in _COLUMNS.split(", "))])


def measure(docs: DataFrame) -> DataFrame:
    """The counts of every row (``doc_id, text, lang, source``): ``n_words``,
    ``word_chars`` (code points in words), ``n_symbols``, ``n_lines`` (with a
    word), ``n_dup_lines``, ``n_repeat_words``, ``n_same_words``, and
    ``base_failed`` (under 20 words, or over 30 % of the words repeated)."""
    ready(docs)
    told = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.col("lang").cast("string").alias("lang"),
                       F.col("source").cast("string").alias("source"))
    rows = told.mapInArrow(_measures, f"doc_id long, lang string, source string, {_COLUMNS}")
    return rows.withColumn("base_failed", (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words")))


def buckets() -> dict[str, F.Column]:
    """Each measure of a row as a sketch bucket (integer arithmetic only)."""
    def share(part: str, whole: str, unit: int) -> F.Column:
        return F.expr(f"least({unit} * {part} div greatest({whole}, 1), {TOP_BUCKET})")
    return {"symbols": share("n_symbols", "word_chars", 1000), "lines": share("n_dup_lines", "n_lines", 1000),
            "repeats": share("n_repeat_words", "n_words", 1000), "same": share("n_same_words", "n_words", 1000),
            "length": share("word_chars", "n_words", 100)}


def sketches(measured: DataFrame) -> DataFrame:
    """``lang, source, name, bucket, n`` of the rows that pass the base rule."""
    pairs = F.explode(F.array(*(F.struct(F.lit(k).alias("name"), v.alias("bucket")) for k, v in buckets().items())))
    return (measured.where(~F.col("base_failed")).select("lang", "source", pairs.alias("p"))
            .groupBy("lang", "source", "p.name", "p.bucket").agg(F.count("*").alias("n")))


def _limits(sketch: DataFrame, by: list[str]) -> DataFrame:
    """Threshold of each merged sketch; ``by`` are the columns that stay."""
    merged = sketch.groupBy(*by, "name", "bucket").agg(F.sum("n").alias("n"))
    group = Window.partitionBy(*by, "name")
    ranked = (merged.withColumn("seen", F.sum("n").over(group.orderBy("bucket")))
              .withColumn("docs", F.sum("n").over(group)))
    at = ranked.groupBy(*by, "name").agg(
        F.max("docs").alias("docs"), F.min(F.when(F.expr("4 * seen >= docs"), F.col("bucket"))).alias("low"),
        F.min(F.when(F.expr("2 * seen >= docs"), F.col("bucket"))).alias("mid"))
    floor = F.coalesce(*(F.when(F.col("name") == k, F.lit(v)) for k, v in FLOORS.items()))
    at = at.withColumn("most", F.col("mid") + REACH * F.greatest(F.col("mid") - F.col("low"), floor))
    return at.groupBy(*by).agg(F.max("docs").alias("docs"), *(
        F.max(F.when(F.col("name") == k, F.col("most"))).alias(k) for k in FLOORS))


def thresholds(sketch: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """One row per (language, source): the largest allowed bucket of each
    measure, from the smallest group with ``min_docs`` documents."""
    own, lang, whole = _limits(sketch, ["lang", "source"]), _limits(sketch, ["lang"]), _limits(sketch, [])
    names = list(FLOORS)

    def named(df, prefix):
        return df.select(*(F.col(c).alias(f"{prefix}_{c}") for c in df.columns))

    joined = own.join(named(lang, "lang"), F.col("lang").eqNullSafe(F.col("lang_lang"))).join(named(whole, "all"), F.lit(True))
    return joined.select("lang", "source", "docs", *(
        F.when(F.col("docs") >= min_docs, F.col(k)).when(F.col("lang_docs") >= min_docs, F.col(f"lang_{k}"))
        .otherwise(F.col(f"all_{k}")).alias(k) for k in names))


def judge(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """The measures of every row with ``base_failed`` and ``kept``."""
    measured = written(measure(docs), "quality-measures", TEXT_ROWS)
    limits = written(thresholds(sketches(measured), min_docs), "quality-limits")
    limits = limits.select(F.col("lang").alias("of_lang"), F.col("source").alias("of_source"), *(
        F.col(k).alias(f"most_{k}") for k in FLOORS))
    joined = measured.join(checked_broadcast(limits, limits.count(), BROADCAST_GROUPS),
                           F.col("lang").eqNullSafe(F.col("of_lang")) & F.col("source").eqNullSafe(F.col("of_source")), "left")
    good = F.lit(True)
    for k, v in buckets().items():
        good = good & (v <= F.col(f"most_{k}"))
    return joined.select(*measured.columns, (~F.col("base_failed") & good).alias("kept"))
