"""Substring deduplication by fixed-block anchors.

A window is ``width`` consecutive words of one document.  Every word covered
by a window whose word sequence also starts earlier (smaller ``doc_id``, or
the same document and an earlier start) is removed; windows are judged on the
input.

Every document is cut into non-overlapping reference blocks of ``width // 2``
words.  Any repeated window holds a whole block of its earlier occurrence, so:

1. every rolling window of block length probes the index of blocks, and a
   block value that occurs at two places anchors all its places;
2. around the anchors the full windows are compared; the first place of each
   window value stays and the others are hits, and consecutive hits are the
   maximal exact repeats.

Both comparisons are shuffles by hash value of packed arrays, not of rows.
Documents are dealt into batches (a few MB of text, by hash of ``doc_id``);
each batch sends one row per hash range with the *distinct* values it holds,
so a passage that every document holds costs a range one entry per batch.
Blocks and probes travel as 32-bit values (a false anchor only adds a
comparison); windows are told apart by 80 bits.  The text itself is shuffled
once, and that exchange serves all three passes.

Defined results: a null or empty text has no words and keeps none; a null
``doc_id`` sorts before all others; rows that repeat a ``doc_id`` are the same
document, so equal windows at equal starts do not remove each other and an
earlier start in either row does; no rows give no rows; further columns of the
input are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dichot.llm.spark import parts, per_group, per_pair, ready, text_bytes
from dichot.llm.text import Words, binary, pack_deltas, slices, spread, unpack_deltas

WIDTH = 20
BATCH_BYTES = 2 << 20
RANGE_BYTES = 16 << 20
_SPACED = re.compile(rb"[^\x20\x09-\x0D]+[\x20\x09-\x0D]*")
_CHECK = 0xA0761D6478BD642F | 1


def _ordered(table: pa.Table) -> pa.Table:
    """A batch in document order, in one chunk."""
    return table.sort_by([("doc_id", "ascending")]).combine_chunks()


def _ids(table: pa.Table) -> np.ndarray:
    ids = table.column("doc_id").combine_chunks()
    return ids.fill_null(np.iinfo(np.int64).min).to_numpy(zero_copy_only=False).astype(np.int64)


class _Batch:
    """Word windows of one batch: arrays over all its words, in document order."""

    def __init__(self, table: pa.Table, width: int, ranges: int, blocks: bool, full: bool) -> None:
        ids = _ids(table)
        probe, fits, whole, check, covers, start, doc = [], [], [], [], [], [], []
        row = 0
        for part in slices(table, "text"):
            words = Words(part.column("text"))
            hashes = words.hashes()
            if blocks:
                h, ok = words.windows(hashes, width // 2)
                probe.append(h)
                fits.append(ok)
            if full:
                h, ok = words.windows(hashes, width)
                whole.append(h)
                covers.append(ok)
                check.append((words.windows(hashes, width, _CHECK)[0] >> np.uint64(48)).astype(np.uint16))
            start.append((np.arange(len(words)) - np.repeat(words.first[:-1], words.counts)).astype(np.int32))
            doc.append(ids[row + words.text_of])
            row += part.num_rows

        def join(x, kind):
            out = np.concatenate(x) if x else np.zeros(0, dtype=kind)
            x.clear()                   # the pieces go at once, not after the last array
            return out

        self.start, self.doc = join(start, np.int32), join(doc, np.int64)
        if blocks:
            self.probe, self.fits = join(probe, np.uint64), join(fits, bool)
            self.key = ((self.probe >> np.uint64(32)) % np.uint64(ranges) << np.uint64(32)) | (self.probe & np.uint64(0xFFFFFFFF))
        if full:
            self.whole, self.covers, self.check = join(whole, np.uint64), join(covers, bool), join(check, np.uint16)


def _probes(width: int, ranges: int, table: pa.Table) -> pa.Table:
    """Distinct probes of a batch by hash range: all, those it holds twice, and
    those that are blocks."""
    b = _Batch(_ordered(table), width, ranges, blocks=True, full=False)
    keys = np.sort(b.key[b.fits])
    new = np.ones(len(keys), dtype=bool)
    new[1:] = keys[1:] != keys[:-1]
    again = np.unique(keys[~new])
    keys = keys[new]
    block = np.unique(b.key[b.fits & (b.start % (width // 2) == 0)])
    batch = table.column("batch")[0].as_py()
    # only ranges that the batch holds: their number is bounded by its words
    rows = np.unique(keys >> np.uint64(32))
    cut = [[np.searchsorted(x, (rows + np.uint64(more)) << np.uint64(32)) for more in (0, 1)] for x in (keys, again, block)]

    def packed(x, c):
        return binary([pack_deltas(x[lo:hi].astype(np.uint32)) for lo, hi in zip(*c)])

    return pa.table({"range": pa.array(rows.astype(np.int64)), "batch": pa.array([batch] * len(rows), pa.int64()),
                     "probes": packed(keys, cut[0]), "twice": packed(again, cut[1]), "blocks": packed(block, cut[2])})


def _anchors(table: pa.Table) -> pa.Table:
    """Of one hash range: per batch, the probes whose value is a block somewhere
    and that have a second place somewhere."""
    probes = [unpack_deltas(x) for x in table.column("probes").to_pylist()]
    every = np.sort(np.concatenate(probes))
    twice = every[1:][every[1:] == every[:-1]]
    twice = np.unique(np.concatenate([twice, *map(unpack_deltas, table.column("twice").to_pylist())]))
    blocks = np.unique(np.concatenate([unpack_deltas(x) for x in table.column("blocks").to_pylist()]))
    found = np.intersect1d(twice, blocks, assume_unique=True)
    hits = [np.intersect1d(x, found, assume_unique=True) for x in probes]
    keep = [i for i, x in enumerate(hits) if len(x)]
    return pa.table({"batch": table.column("batch").combine_chunks().take(pa.array(keep, pa.int64())),
                     "range": table.column("range").combine_chunks().take(pa.array(keep, pa.int64())),
                     "hits": binary([pack_deltas(hits[i]) for i in keep])})


def _member(values: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Whether each value is in the ascending array ``wanted``."""
    if not len(wanted):
        return np.zeros(len(values), dtype=bool)
    at = np.searchsorted(wanted, values)
    at[at == len(wanted)] = 0
    return wanted[at] == values


def _firsts(key: np.ndarray, doc: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order positions by (key, document, start); ``lead[i]`` is the place in
    that order at which the run of the i-th one's key begins."""
    order = np.argsort(key, kind="stable") if len(doc) < 2 or (np.diff(doc) >= 0).all() and not _repeats(doc, start) \
        else np.lexsort((start, doc, key))
    k = key[order]
    new = np.ones(len(k), dtype=bool)
    new[1:] = k[1:] != k[:-1]
    lead = np.maximum.accumulate(np.where(new, np.arange(len(k)), 0))
    return order, lead


def _repeats(doc: np.ndarray, start: np.ndarray) -> bool:
    """Whether two rows share a document id (its starts then begin again)."""
    return bool(((doc[1:] == doc[:-1]) & (start[1:] <= start[:-1])).any())


def _windows(width: int, ranges: int, docs: pa.Table, hits: pa.Table) -> pa.Table:
    """Distinct full windows around the anchors of a batch, by hash range, each
    with the smallest document that holds it."""
    empty = pa.table({"range": pa.array([], pa.int64()), "batch": pa.array([], pa.int64()), "keys": binary([]),
                      "checks": binary([]), "low": binary([]), "high": binary([])})
    if not docs.num_rows or not hits.num_rows:
        return empty
    b = _Batch(_ordered(docs), width, ranges, blocks=True, full=True)
    wanted = np.sort(np.concatenate([unpack_deltas(h).astype(np.uint64) | (np.uint64(r) << np.uint64(32))
                                     for r, h in zip(hits.column("range").to_pylist(), hits.column("hits").to_pylist())]))
    anchored = _member(b.key, wanted) & b.fits
    near = spread(anchored[::-1], width - width // 2 + 1)[::-1] & b.covers
    at = np.flatnonzero(near)
    key, check, doc, start = b.whole[at], b.check[at], b.doc[at], b.start[at]
    order, lead = _firsts(key, doc, start)
    first = order[lead == np.arange(len(lead))]
    # two windows with one 64-bit value and other check bits: keep a place of each
    other = order[check[order] != check[order[lead]]] if len(order) else order
    first = np.concatenate([first, other])
    part = key[first] % np.uint64(ranges)
    first = first[np.argsort(part, kind="stable")]
    part = np.sort(part)
    rows, cut = np.unique(part, return_index=True)
    cut = [*cut.tolist(), len(part)]
    batch = docs.column("batch")[0].as_py()
    ids = doc.view(np.uint64)

    def packed(values, kind):
        return binary([values[first[lo:hi]].astype(kind).tobytes() for lo, hi in zip(cut, cut[1:])])

    return pa.table({"range": pa.array(rows.astype(np.int64)), "batch": pa.array([batch] * len(rows), pa.int64()),
                     "keys": packed(key, "<u8"), "checks": packed(check, "<u2"),
                     "low": packed(ids & np.uint64(0xFFFFFFFF), "<u4"), "high": packed(ids >> np.uint64(32), "<u4")})


def _later(table: pa.Table) -> pa.Table:
    """Of one hash range: per batch, the windows that a smaller document of
    another batch holds."""
    def column(name, kind):
        return [np.frombuffer(x, dtype=kind) for x in table.column(name).to_pylist()]

    keys = column("keys", "<u8")
    sizes = np.array([len(x) for x in keys])
    row = np.repeat(np.arange(len(keys)), sizes)
    key, check = np.concatenate(keys), np.concatenate(column("checks", "<u2"))
    doc = (np.concatenate(column("low", "<u4")).astype(np.uint64)
           | (np.concatenate(column("high", "<u4")).astype(np.uint64) << np.uint64(32))).view(np.int64)
    order = np.lexsort((doc, check, key))
    k, c, d = key[order], check[order], doc[order]
    new = np.ones(len(k), dtype=bool)
    new[1:] = (k[1:] != k[:-1]) | (c[1:] != c[:-1])
    lead = np.maximum.accumulate(np.where(new, np.arange(len(k)), 0))
    hit = order[d > d[lead]]
    hit = hit[np.lexsort((key[hit], row[hit]))]
    cut = np.searchsorted(row[hit], np.arange(len(keys) + 1))
    keep = [i for i in range(len(keys)) if cut[i + 1] > cut[i]]
    return pa.table({"batch": table.column("batch").combine_chunks().take(pa.array(keep, pa.int64())),
                     "later": binary([key[hit[cut[i]:cut[i + 1]]].astype("<u8").tobytes() for i in keep])})


def _strip(width: int, ranges: int, spaced: bool, carried: list[str], docs: pa.Table, later: pa.Table) -> pa.Table:
    """Remove the words under hit windows from the documents of a batch; with
    ``spaced``, each kept word keeps the white space after it.  The columns
    ``carried`` come along."""
    docs = _ordered(docs)
    b = _Batch(docs, width, ranges, blocks=False, full=True)
    hit = np.zeros(len(b.doc), dtype=bool)
    if later.num_rows:
        hit = _member(b.whole, np.sort(np.concatenate([np.frombuffer(x, dtype="<u8") for x in later.column("later").to_pylist()])))
        hit &= b.covers
    at = np.flatnonzero(b.covers)
    order, lead = _firsts(b.whole[at], b.doc[at], b.start[at])
    spot, first = at[order], at[order[lead]] if len(order) else at
    own = (b.doc[spot] != b.doc[first]) | (b.start[spot] != b.start[first])
    hit[spot[own & (b.check[spot] == b.check[first])]] = True
    gone = spread(hit, width)
    n_words, n_removed, kept, row = [], [], [], 0
    for text in docs.column("text"):
        raw = (text.as_py() or "").encode()
        words = _SPACED.findall(raw) if spaced else raw.split()
        mask = gone[row:row + len(words)]
        row += len(words)
        n_words.append(len(words))
        n_removed.append(int(mask.sum()))
        left = compress(words, (~mask).tolist()) if n_removed[-1] else words
        kept.append(b"".join(left).rstrip() if spaced else b" ".join(left))
    more = {f"carry_{i}": docs.column(c) for i, c in enumerate(carried)}
    return pa.table({"doc_id": docs.column("doc_id"), **more, "n_words": pa.array(n_words, pa.int64()),
                     "n_removed": pa.array(n_removed, pa.int64()), "kept_text": pa.array(kept, pa.binary()).cast(pa.string())})


def strip_repeats(docs: DataFrame, width: int = WIDTH, batch_bytes: int = BATCH_BYTES,
                  range_bytes: int = RANGE_BYTES, carry: Sequence[str] = (), spaced: bool = False) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_text`` for every row of ``docs``
    (``doc_id`` integer, ``text``); see the module for the rules.  Columns named
    in ``carry`` come along as ``carry_0``, ``carry_1``, ...  Kept words are joined by
one space or, with ``spaced``, by the white space that followed each in the text."""
    if width < 4:
        raise ValueError("width must be at least 4")
    spark = ready(docs)
    kinds = "".join(f", carry_{i} {docs.schema[c].dataType.simpleString()}" for i, c in enumerate(carry))
    # the text travels once, also where it is carried
    carried = ["text" if c == "text" else f"carry_{i}" for i, c in enumerate(carry)]
    more = [docs[c].alias(name) for c, name in zip(carry, carried) if c != "text"]
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", *more)
    size = text_bytes(docs)
    batches, ranges = parts(spark, size, batch_bytes), parts(spark, size, range_bytes)
    dealt = docs.withColumn("batch", F.pmod(F.xxhash64("doc_id"), F.lit(batches)))
    by_batch = dealt.groupBy("batch")
    probes = by_batch.applyInArrow(
        per_group(_probes, width, ranges), "range long, batch long, probes binary, twice binary, blocks binary")
    hits = probes.groupBy("range").applyInArrow(per_group(_anchors), "batch long, range long, hits binary")
    windows = by_batch.cogroup(hits.groupBy("batch")).applyInArrow(
        per_pair(_windows, width, ranges), "range long, batch long, keys binary, checks binary, low binary, high binary")
    later = windows.groupBy("range").applyInArrow(per_group(_later), "batch long, later binary")
    return by_batch.cogroup(later.groupBy("batch")).applyInArrow(
        per_pair(_strip, width, ranges, spaced, carried), f"doc_id long{kinds}, n_words long, n_removed long, kept_text string")
