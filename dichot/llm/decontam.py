"""Benchmark decontamination by size-partitioned MinHash containment search.

Texts are lower-cased and cut into words at everything but letters and digits;
shingles are ``n`` consecutive words.  A document is contaminated by an item
when it holds at least ``percent`` of the item's distinct shingles.

An item with fewer than ``n`` words is one shingle of its own length (its whole
word sequence), in a size partition of its own per length; documents are probed
by windows of such a length only where some item has it.

Items are partitioned by set size (powers of two).  An item with ``m`` shingles
may miss ``m - need`` of them, ``need`` being the smallest allowed hit count,
so its MinHash sketch holds its ``m - need + 1`` smallest hash values: any
document that contains the item holds one of them.  Documents are searched
whole, without windows or sizes of their own: every shingle probes the sketch
index, a partition is only open to documents with as many shingles as its
smallest items need, and each candidate is verified by the exact share of the
item's shingles in the document's set.

Everything is DataFrame functions.  The sketch index is broadcast in blocks of
a fixed number of entries, one search per block, so its size per search is
bounded however many items there are; the hot passage that many documents hold
only makes rows in its own documents.

Defined results: null or empty texts, and texts without a letter or digit, have
no shingles and are in no pair; a document shorter than an item does not hold it; rows that repeat a
``doc_id`` or an ``item_id`` are judged together by their best pair; null ids
are in no pair; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dichot.llm.spark import ready, written

SHINGLE = 5
PERCENT = 80
BLOCK_ENTRIES = 1 << 20


def shingle_sets(df: DataFrame, key: str, n: int, lengths: list[int], whole: bool = False) -> DataFrame:
    """``key, shingles``: the distinct hashes of every text's windows of ``n`` words
    (null where it has none).  With ``whole``, a shorter text is one window of its
    own length; otherwise windows of the given shorter ``lengths`` are added.  The
    words are bound to a lambda variable, so they are computed once per text
    wherever the optimizer moves the expression."""
    words = F.filter(F.split(F.lower("text"), r"[^\p{L}\p{N}]+"), lambda w: w != "")

    def windows(w, k):
        def one(i):
            # windows of other lengths are told apart by their length
            return F.xxhash64(*([] if k == n else [F.lit(k)]), *(F.get(w, i + j) for j in range(k)))
        return F.when(F.size(w) >= k, F.transform(F.sequence(F.lit(0), F.size(w) - k), one))

    def shingles(w):
        own = windows(w, n)
        if whole:
            for k in range(1, n):
                own = F.when(F.size(w) == k, windows(w, k)).otherwise(own)
        elif lengths:
            none = F.array().cast("array<bigint>")
            own = F.concat(*(F.coalesce(windows(w, k), none) for k in (n, *lengths)))
        return F.array_distinct(own)
    return df.select(F.col(key).cast("long").alias(key), F.get(F.transform(F.array(words), shingles), F.lit(0)).alias("shingles"))


def short_lengths(items: DataFrame, n: int) -> list[int]:
    """The word counts below ``n`` that items have (at most ``n - 1`` numbers)."""
    count = F.size(F.filter(F.split(F.lower("text"), r"[^\p{L}\p{N}]+"), lambda w: w != ""))
    few = items.where("item_id is not null and text is not null").select(count.alias("k")).where(F.col("k").between(1, n - 1))
    return sorted(r["k"] for r in few.distinct().collect())


def sketches(items: DataFrame, n: int, percent: int) -> DataFrame:
    """``item_id, item_set, need, partition, value``: one row per sketch entry."""
    sets = written(shingle_sets(items, "item_id", n, [], whole=True), "decontam-items").where("item_id is not null and size(shingles) > 0")
    need = F.expr(f"({percent} * size(shingles) + 99) div 100")
    return (sets.withColumn("need", need)
            .withColumn("partition", F.floor(F.log2(F.size("shingles"))).cast("int"))
            .select("item_id", F.col("shingles").alias("item_set"), "need", "partition",
                    F.explode(F.slice(F.sort_array("shingles"), F.lit(1), (F.size("shingles") - F.col("need") + 1).cast("int"))).alias("value")))


def contaminated(docs: DataFrame, items: DataFrame, n: int = SHINGLE, percent: int = PERCENT,
                 block: int = BLOCK_ENTRIES) -> DataFrame:
    """``doc_id, item_id, item_shingles, shared`` for every contaminated document
    of ``docs`` (``doc_id`` integer, ``text``) and item (``item_id``, ``text``)."""
    if n < 1 or not 1 <= percent <= 100:
        raise ValueError("n must be positive and percent from 1 to 100")
    ready(docs)
    index = written(sketches(items, n, percent), "decontam-sketches")
    entries = index.count()
    blocks = max(1, -(-entries // block))
    sets = shingle_sets(docs.select("doc_id", "text"), "doc_id", n, short_lengths(items, n))
    probes = sets.select("doc_id", "shingles", F.explode_outer("shingles").alias("value"))
    found = []
    for b in range(blocks):
        part = index.where(F.pmod(F.xxhash64("value"), F.lit(blocks)) == b)
        least = part.groupBy("partition").agg(F.min("need").alias("least"))
        part = part.join(F.broadcast(least), "partition")
        hits = probes.join(F.broadcast(part), "value")
        shared = F.when(F.size("shingles") >= F.col("least"), F.size(F.array_intersect("item_set", "shingles")))
        found.append(hits.select("doc_id", "item_id", F.size("item_set").alias("item_shingles"), "need", shared.alias("shared"))
                     .where("shared >= need"))
    pairs = reduce(DataFrame.unionByName, found)
    return (pairs.where("doc_id is not null").groupBy("doc_id", "item_id").agg(F.max(F.struct("shared", "item_shingles")).alias("best"))
            .select("doc_id", "item_id", F.col("best.item_shingles").cast("long").alias("item_shingles"),
                    F.col("best.shared").cast("long").alias("shared")))
