"""A corpus pipeline: quality rules, near-dedup, substring dedup, benchmark
decontamination, packing.

``STAGES`` lists ``(name, function)``; each function takes ``(spark, docs,
sf_dir)`` and returns a DataFrame, which is written and read again as the next
one's ``docs``.  All but the last return the columns of ``documents``.

Decisions are made row by row: a stage that drops documents writes its rows
with a key of their own first, so rows that share a ``doc_id`` (also a null one)
are judged apart.  Nulls and empty texts fail the quality rules; later stages
keep them.  Among near-duplicates the smallest ``doc_id`` stays, a null one last;
rows that tie in it are told apart by their key.  Only the substring stage sees
rows of one ``doc_id`` as one document.  No rows give no rows; columns beyond
those of ``documents``, of any name, pass through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dichot.llm import decontam, near_dup, packing, quality, substring
from dichot.llm.queries import RANKS, TOKENIZER
from dichot.llm.spark import checked_broadcast, written
from dichot.session import table

#: ids of removed documents that may be broadcast; beyond it the join shuffles
BROADCAST_IDS = 1 << 21


def _keyed(docs: DataFrame) -> tuple[DataFrame, DataFrame, str]:
    """``docs`` written with a key for every row, the same as operators take it
    (the key as ``doc_id``), and the name of the key."""
    key = "row_key"
    while key in (c.lower() for c in docs.columns):
        key += "_"
    keyed = written(docs.withColumn(key, F.monotonically_increasing_id()), "keyed")
    told = keyed.select(F.col(key).alias("doc_id"), *(c for c in ("text", "lang", "source") if c in docs.columns))
    return keyed, told, key


def _without(keyed: DataFrame, key: str, gone: DataFrame, name: str) -> DataFrame:
    """The rows of ``keyed`` whose key is not in ``gone`` (one column), without the key."""
    gone = written(gone.toDF(key).distinct(), name)
    return keyed.join(checked_broadcast(gone, gone.count(), BROADCAST_IDS), key, "left_anti").drop(key)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the adaptive quality rules reject go."""
    keyed, told, key = _keyed(docs)
    return _without(keyed, key, quality.judge(told).where("not kept").select("doc_id"), "rejected").select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (five-word shingles,
    similarity 0.8) stays: the one with the smallest id."""
    keyed, told, key = _keyed(docs)
    found = written(near_dup.near_duplicates(told, n=5).select(F.col("doc_id").alias("row"), "component_id"), "groups")
    # groups of two rows and more: their first row by id stays
    several = found.where("row <> component_id").select(F.col("component_id").alias("group")).distinct()
    member = found.join(several, F.col("component_id") == F.col("group"), "left_semi")
    named = member.join(keyed.select(F.col(key).alias("of_row"), "doc_id"), F.col("row") == F.col("of_row"))
    first = named.groupBy("component_id").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row"))["row"].alias("row"))
    gone = member.select("row").join(first.select("row"), "row", "left_anti")
    return _without(keyed, key, gone, "copies").select(*docs.columns)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words of repeated passages go, kept ones keep their white space; a text
    without a repeat stays as it is."""
    more = [c for c in docs.columns if c != "doc_id"]
    out = substring.strip_repeats(docs, carry=[c for c in more if c not in ("text", "n_chars")] + ["text", "n_chars"], spaced=True)
    rest = [c for c in more if c not in ("text", "n_chars")]
    place = {c: f"carry_{i}" for i, c in enumerate([*rest, "text", "n_chars"])}
    changed = F.col("n_removed") > 0
    columns = {"doc_id": F.col("doc_id").cast(docs.schema["doc_id"].dataType),
               "text": F.when(changed, F.col("kept_text")).otherwise(F.col(place["text"])),
               "n_chars": F.when(changed, F.length("kept_text")).otherwise(F.col(place["n_chars"])).cast(docs.schema["n_chars"].dataType)}
    return out.select(*((columns[c] if c in columns else F.col(place[c])).alias(c) for c in docs.columns))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    keyed, told, key = _keyed(docs)
    found = decontam.contaminated(told, table(spark, sf_dir, "benchmark"))
    return _without(keyed, key, found.select("doc_id"), "contaminated").select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of 2048 tokens."""
    return packing.pack(docs, TOKENIZER, RANKS)


STAGES = [
    ("quality rules", quality_rules),
    ("minhash near-dedup", near_dedup),
    ("substring dedup", substring_dedup),
    ("benchmark decontamination", decontaminate),
    ("best-fit packing", pack),
]

#: tokens are not expressible in SQL; tests hold run() against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each written to the shared checkpoint folder but the last."""
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = written(docs, f"stage-{i}")
    return docs
