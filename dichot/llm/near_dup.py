"""Near-duplicate detection by a signature-coordinate inverted join.

The text of a document is lower-cased (A-Z) and cut into words; its set is
its distinct ``n``-word shingles (a shorter document: its whole word sequence
as one shingle).  Two documents are linked when ``100 * |A and B| >= percent *
|A or B|``.

1. Documents with equal sets form one class (a grouped minimum, combined
   map-side), so exact copies never meet one another again.
2. Each class representative posts its MinHash signature: one document id
   under each (coordinate, value) pair.  Pairs that one class alone holds are
   skipped.  To reach ``match`` equal coordinates two classes must share one of
   their ``coordinates - match + 1`` rarest pairs, so only this prefix of each
   signature is kept in the lists.
3. Members of one list are compared by two-bit signatures (a count of equal
   coordinates), set sizes and parity bitmaps; pairs at or above the match
   threshold are confirmed on the full sets.  A parity bitmap has one bit per
   hash bin, set when an odd number of shingles falls there.  Bins where two
   bitmaps differ each hold a shingle that only one of the sets has, so their
   count never exceeds the symmetric difference, and a pair whose count is
   beyond what the similarity allows is not linked: no link is lost to it.
4. A list is never expanded into all its pairs at once.  Its members become
   hubs in rounds (first the most central member, then growing shares of the list
   by a fixed hash), and a hub only meets members that are not yet connected
   with it and that are outside the largest component of the list or have been
   hubs before.  A pair that stays unconnected has therefore been tested when
   the later of the two was a hub, so no link between components is lost, and
   a group of n mutual copies costs about n comparisons.  Lists hold slim rows,
   a list leaves once its members are connected or were all hubs, and the files
   of a round are deleted when the next has written its own.

With 64 coordinates and a threshold of 32, a pair at similarity 0.8 misses the
threshold with probability 2e-7; higher similarities with less.

Defined results: a text without words (or null) has an empty set and is linked
with nothing; rows that repeat a ``doc_id``, also with other texts, are one
document, whose classes are linked, and are returned one by one; a null
``doc_id`` is kept, forms its own component with a null id, and does not take
part in links; no rows give no rows; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from dichot.llm.components import components
from dichot.llm.spark import TEXT_ROWS, checked_broadcast, freed, ready, written
from dichot.llm.text import Words, binary, mix, slices

COORDINATES = 64
MATCH = 32
LOW_BITS_MATCH = 38
BITMAP_WORDS = 8
_BITMAP = [f"b{k}" for k in range(BITMAP_WORDS)]
BROADCAST_IDS = 1 << 21
#: hubs, heads and roots of a round are broadcast up to so many rows, and shuffled beyond
BROADCAST_ROUND = 1 << 16
#: from round to round, how much the share of hubs grows
GROWTH = 16
#: a class of so many rows, and of a 2^-20 share of all, is joined by broadcast (at most 2^20 classes are)
HOT_ROWS = 1000
_POSTED = ["n", "s1", "s2", *_BITMAP, "weight"]
_DIGEST = ["one", "two", "n_shingles"]
_U = np.uint64
_FACTORS = mix(np.arange(1, COORDINATES + 1, dtype=np.uint64) * _U(0xC2B2AE3D27D4EB4F)) | _U(1)


def _sets(texts: pa.Array, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of each text: ``(values, first)``; the set of text ``i``
    is the ascending ``values[first[i]:first[i + 1]]``."""
    words = Words(texts)
    hashes = words.hashes(lower=True)
    value, fits = words.windows(hashes, n)
    at = np.flatnonzero(fits)
    doc, value = words.text_of[at], value[at]
    short = np.flatnonzero((words.counts > 0) & (words.counts < n))
    if len(short):
        acc = np.zeros(len(short), dtype=np.uint64)
        for k in range(n - 1):
            more = words.counts[short] > k
            acc[more] = mix(acc[more] * _U(31) + hashes[words.first[short[more]] + k])
        doc, value = np.concatenate([doc, short]), np.concatenate([value, acc])
    order = np.argsort(value, kind="stable")
    order = order[np.argsort(doc[order], kind="stable")]
    doc, value = doc[order], value[order]
    new = np.ones(len(doc), dtype=bool)
    new[1:] = (doc[1:] != doc[:-1]) | (value[1:] != value[:-1])
    doc, value = doc[new], value[new]
    return value, np.searchsorted(doc, np.arange(len(texts) + 1))


def _digests(value: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Two 64-bit sums of each set (sets begin at ``begin``) and the mixed values of the second."""
    mixed = mix(value ^ _U(0x5851F42D4C957F2D))
    return np.add.reduceat(mix(value), begin), np.add.reduceat(mixed, begin), mixed


def _signatures(n: int):
    """Per document: set size, a 128-bit digest of the set, the signature, and
    the parity bitmap."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", 1 << 20):
                value, first = _sets(part.column("text"), n)
                size = np.diff(first)
                full = np.flatnonzero(size)
                begin = first[:-1][full]
                one, two = np.zeros(len(size), dtype=np.uint64), np.zeros(len(size), dtype=np.uint64)
                sig = np.zeros((len(size), COORDINATES), dtype=np.uint32)
                bitmap = np.zeros((BITMAP_WORDS, len(size)), dtype=np.uint64)
                if len(full):
                    one[full], two[full], mixed = _digests(value, begin)
                    bit, word = _U(1) << (mixed & _U(63)), (mixed >> _U(6)) % _U(BITMAP_WORDS)
                    for k in range(BITMAP_WORDS):
                        bitmap[k, full] = np.bitwise_xor.reduceat(np.where(word == _U(k), bit, _U(0)), begin)
                    for k in range(COORDINATES):
                        x = value * _FACTORS[k]
                        x ^= x >> _U(29)
                        x *= _U(0xBF58476D1CE4E5B9)
                        sig[full, k] = np.minimum.reduceat((x >> _U(32)).astype(np.uint32), begin)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(size, pa.int64()), pa.array(one.view(np.int64)), pa.array(two.view(np.int64)),
                     pa.FixedSizeListArray.from_arrays(pa.array(sig.view(np.int32).ravel()), COORDINATES).cast(pa.list_(pa.int32())),
                     *(pa.array(row.view(np.int64)) for row in bitmap)],
                    names=["doc_id", "n_shingles", "one", "two", "signature", *_BITMAP])
    return run


def _full_sets(n: int):
    """The sets of the rows whose text is that of the class they were looked up for."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                value, first = _sets(part.column("text"), n)
                size = np.diff(first)
                one, two = part.column("one").to_numpy().view(np.uint64), part.column("two").to_numpy().view(np.uint64)
                full = np.flatnonzero(size)
                same = np.zeros(len(size), dtype=bool)
                if len(full):
                    x, y, _ = _digests(value, first[:-1][full])
                    same[full] = (x == one[full]) & (y == two[full])
                rows = np.flatnonzero(same)
                yield pa.RecordBatch.from_arrays(
                    [part.column("rep").take(pa.array(rows)), binary([value[first[i]:first[i + 1]].tobytes() for i in rows])],
                    names=["rep", "elements"])
    return run


def _confirm(percent: int):
    """Keep the pairs whose full sets are similar enough."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for i, (x, y) in enumerate(zip(batch.column("left").to_pylist(), batch.column("right").to_pylist())):
                x, y = np.frombuffer(x, dtype=np.uint64), np.frombuffer(y, dtype=np.uint64)
                both = np.concatenate([x, y])
                both.sort(kind="stable")
                shared = int((both[1:] == both[:-1]).sum())
                if 100 * shared >= percent * (len(x) + len(y) - shared):
                    keep.append(i)
            took = batch.select(["a", "b"]).take(pa.array(keep, pa.int64()))
            yield took
    return run


def _two_bits(word: int) -> F.Column:
    """32 coordinates of a signature, two bits each, in one long."""
    out = F.lit(0).cast("long")
    for k in range(32):
        bits = F.col("signature").getItem(32 * word + k).bitwiseAND(F.lit(3)).cast("long")
        out = out.bitwiseOR(F.shiftleft(bits, 2 * k))
    return out


def _equal_coordinates() -> F.Column:
    """How many two-bit coordinates of two postings agree."""
    out = F.lit(COORDINATES)
    for s in ("s1", "s2"):
        x = F.col(f"h.{s}").bitwiseXOR(F.col(f"m.{s}"))
        odd = x.bitwiseOR(F.shiftrightunsigned(x, 1)).bitwiseAND(F.lit(0x5555555555555555).cast("long"))
        out = out - F.bit_count(odd)
    return out


def _near_enough(percent: int) -> F.Column:
    """Whether the parity bitmaps of two postings allow the similarity: linked
    sets differ in at most ``(100 - percent) / (100 + percent)`` of their summed sizes."""
    apart = F.lit(0)
    for b in _BITMAP:
        apart = apart + F.bit_count(F.col(f"h.{b}").bitwiseXOR(F.col(f"m.{b}")))
    return apart * (100 + percent) <= (F.col("h.n") + F.col("m.n")) * (100 - percent)


def _postings(classes: DataFrame) -> DataFrame:
    """``key, rep, n, s1, s2, b0.., weight``: the prefix lists; ``weight`` is how many
    postings share a pair with the member, so an original outweighs its copies."""
    tokens = classes.select("rep", F.posexplode("signature").alias("coordinate", "value")).select(
        F.shiftleft(F.col("coordinate").cast("long"), 32).bitwiseOR(
            F.col("value").cast("long").bitwiseAND(F.lit(0xFFFFFFFF).cast("long"))).alias("key"), "rep")
    held = tokens.groupBy("key").agg(F.count("*").alias("held")).where("held > 1")
    shared = tokens.join(held, "key")
    mine = Window.partitionBy("rep")
    prefix = (shared.withColumn("place", F.row_number().over(mine.orderBy("held", "key")))
              .withColumn("alone", F.lit(COORDINATES) - F.count("*").over(mine))
              .withColumn("weight", F.sum("held").over(mine))
              .where(F.col("place") + F.col("alone") <= COORDINATES - MATCH + 1).select("key", "rep", "weight"))
    facts = classes.select("rep", F.col("n_shingles").alias("n"), _two_bits(0).alias("s1"), _two_bits(1).alias("s2"), *_BITMAP)
    return prefix.join(facts, "rep").select("key", "rep", *_POSTED)


def _verified(pairs: DataFrame, classes: DataFrame, texts: DataFrame, repeated: bool, n: int, percent: int) -> DataFrame:
    """The links among candidate pairs of classes, on full sets."""
    ids = written(pairs.select(F.col("a").alias("rep")).union(pairs.select("b")).distinct(), "near-ids")
    wanted = written(classes.select("rep", F.col("lowest").alias("doc_id"), "one", "two")
                     .join(checked_broadcast(ids, ids.count(), BROADCAST_IDS), "rep"), "near-wanted")
    mine = texts.join(checked_broadcast(wanted, wanted.count(), BROADCAST_IDS), "doc_id")
    sets = mine.select("rep", "one", "two", "text").mapInArrow(_full_sets(n), "rep long, elements binary")
    sets = written(sets.dropDuplicates(["rep"]) if repeated else sets, "near-sets", TEXT_ROWS)
    both = (pairs.join(sets.select(F.col("rep").alias("a"), F.col("elements").alias("left")), "a")
            .join(sets.select(F.col("rep").alias("b"), F.col("elements").alias("right")), "b"))
    links = written(both.select("a", "b", "left", "right").mapInArrow(_confirm(percent), "a long, b long"), "near-links", TEXT_ROWS)
    freed(ids, wanted, sets)
    return links


def _one_document(real: DataFrame, classes: DataFrame) -> tuple[DataFrame | None, bool]:
    """Links ``a, b`` between the classes of ids that repeat with several texts,
    and whether any id repeats at all."""
    digest = F.struct(*_DIGEST)
    ids = real.groupBy("doc_id").agg(F.count("*").alias("rows"), F.min(digest).alias("low"), F.max(digest).alias("high"))
    ids = written(ids.where("rows > 1"), "near-repeated")
    many = ids.where("low <> high").select("doc_id", "low")
    if many.isEmpty():
        return None, not ids.isEmpty()
    pairs = real.join(many, "doc_id").select(*_DIGEST, "low").distinct()
    key = classes.select("rep", *_DIGEST)
    low = key.select(F.col("rep").alias("a"), digest.alias("low"))
    return written(pairs.join(low, "low").join(key, _DIGEST).where("a <> rep").select("a", F.col("rep").alias("b")), "near-same"), True


def _all_links(classes: DataFrame, lists: DataFrame, texts: DataFrame, same: DataFrame | None, repeated: bool, n: int,
               percent: int) -> tuple[DataFrame | None, DataFrame | None]:
    """The confirmed links that join components, and ``rep, root``."""
    links = None
    roots = None if same is None else written(components(same, "a", "b").withColumnRenamed("node", "rep"), "near-roots")
    low, high = 0, 0
    # lists up to this size have had all their pairs tested
    tested = 1
    rounds = 0
    while True:
        now = lists.withColumn("root", F.col("rep")) if roots is None else (
            lists.join(checked_broadcast(roots, roots.count(), BROADCAST_ROUND), "rep", "left")
            .withColumn("root", F.coalesce("root", "rep")))
        share = now.groupBy("key", "root").agg(F.count("*").alias("c"), F.max(F.struct("weight", (-F.col("rep")).alias("less"))).alias("head"))
        # the largest component of each list, its size, its most central member
        heads = written(share.groupBy("key").agg(
            F.sum("c").alias("size"), F.count("*").alias("parts"), F.max(F.struct("c", "root")).alias("top"),
            F.max("head").alias("head")).where((F.col("parts") > 1) & (F.col("size") > tested)), "near-heads")
        n_heads = heads.count()
        if not n_heads:
            freed(heads, lists)
            return links, roots
        open_lists = written(now.join(checked_broadcast(heads, n_heads, BROADCAST_ROUND), "key").select(
            "key", "rep", *_POSTED, "root", "size", (-F.col("head.less")).alias("centre"),
            F.col("top.root").alias("giant"), F.col("top.c").alias("giant_size")), "near-open")
        # lists that are closed now stay closed: components only grow
        freed(heads, lists)
        lists = open_lists.select("key", "rep", *_POSTED)
        lists.written_to = open_lists.written_to
        place = F.pmod(F.xxhash64("rep"), F.lit(1 << 30)) * F.col("size") / F.lit(float(1 << 30))
        if rounds == 0:
            hubs = open_lists.where("rep = centre")
        else:
            hubs = open_lists.where((place >= low) & (place < high))
        # members of the largest component wait until they have been hubs themselves; while
        # every component is one class there is no largest one
        rest = open_lists.where((F.col("giant_size") == 1) | (F.col("root") != F.col("giant")) | (place < high))
        hubs = checked_broadcast(hubs, hubs.count(), BROADCAST_ROUND)
        pair = hubs.alias("h").join(rest.alias("m"), (F.col("h.key") == F.col("m.key")) & (F.col("h.root") != F.col("m.root"))
                                    & (F.col("h.n") * 100 >= F.col("m.n") * percent)
                                    & (F.col("m.n") * 100 >= F.col("h.n") * percent)
                                    & (_equal_coordinates() >= LOW_BITS_MATCH) & _near_enough(percent))
        pairs = written(pair.select(F.least("h.rep", "m.rep").alias("a"), F.greatest("h.rep", "m.rep").alias("b")).distinct(),
                        "near-pairs")
        if not pairs.isEmpty():
            fresh = _verified(pairs, classes, texts, repeated, n, percent)
            links = fresh if links is None else links.union(fresh)
            edges = fresh
            if roots is not None:
                edges = fresh.union(roots.select(F.col("rep").alias("a"), F.col("root").alias("b")))
            before = roots
            roots = written(components(edges, "a", "b").withColumnRenamed("node", "rep"), "near-roots")
            freed(before)
        freed(pairs)
        # the centre's round has tested lists of two, and pairs of hubs those of up to ``high``
        tested = 2 if rounds == 0 else high
        low, high = (0, GROWTH) if rounds == 0 else (high, high * GROWTH)
        rounds += 1


def near_duplicates(docs: DataFrame, n: int, percent: int = 80) -> DataFrame:
    """``doc_id, n_shingles, component_id, class_id, n_links, kept`` for every row
    of ``docs`` (``doc_id`` integer, ``text``).  ``class_id`` is the smallest
    document with an equal set; ``n_links`` counts the confirmed links of the
    class that joined components (not all pairs of a group).  ``percent`` is 80
    or more: the match threshold is set for that."""
    if n < 1 or not 80 <= percent <= 100:
        raise ValueError("n must be positive and percent from 80 to 100")
    ready(docs)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    signed = written(docs.mapInArrow(
        _signatures(n), "doc_id long, n_shingles long, one long, two long, signature array<int>"
        + "".join(f", {b} long" for b in _BITMAP)), "near-signatures", TEXT_ROWS)
    real = signed.where("n_shingles > 0 and doc_id is not null")
    classes = real.groupBy(*_DIGEST).agg(F.min("doc_id").alias("lowest"), F.count("*").alias("members"),
                                         *(F.any_value(c).alias(c) for c in ("signature", *_BITMAP)))
    # a number of its own for every class: one document may be the smallest of several
    classes = written(classes.withColumn("rep", F.monotonically_increasing_id()), "near-classes")
    same, repeated = _one_document(real, classes)
    lists = written(_postings(classes), "near-lists")
    links, roots = _all_links(classes, lists, docs.where("doc_id is not null"), same, repeated, n, percent)

    told = classes.select(*_DIGEST, "rep", "lowest", "members")
    if roots is not None:
        told = told.join(roots, "rep", "left").withColumn("root", F.coalesce("root", "rep"))
        smallest = written(told.groupBy("root").agg(F.min("lowest").alias("component")), "near-components")
        told = told.join(checked_broadcast(smallest, smallest.count(), BROADCAST_IDS), "root")
    else:
        told = told.withColumn("component", F.col("lowest"))
    if links is not None:
        degree = links.select(F.col("a").alias("rep")).union(links.select("b")).groupBy("rep").agg(F.count("*").alias("n_links"))
        told = told.join(degree, "rep", "left")
    else:
        told = told.withColumn("n_links", F.lit(0).cast("long"))
    told = written(told.drop("root", "rep"), "near-told")
    rows = signed.select("doc_id", *_DIGEST)
    # exact copies of one text are joined where they lie, not in one task
    least = max(HOT_ROWS, (told.agg(F.sum("members")).first()[0] or 0) >> 20)
    hot = F.broadcast(told.where(F.col("members") >= least))
    met = F.col("doc_id").isNotNull()
    facts = ["doc_id", "n_shingles", "lowest", "component", "n_links"]
    out = (rows.where(met).join(hot, _DIGEST).select(facts)
           .union(rows.where(met).join(hot, _DIGEST, "left_anti").join(told.where(F.col("members") < least), _DIGEST, "left").select(facts))
           .union(rows.where(~met).select("doc_id", "n_shingles", *(F.lit(None).cast("long") for _ in range(3)))))
    component = F.coalesce("component", "doc_id")
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce("lowest", "doc_id").alias("class_id"),
                      F.coalesce("n_links", F.lit(0)).alias("n_links"),
                      F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))
