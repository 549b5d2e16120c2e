"""Token counts as delta-maintained rollups.

The store is a folder of committed batches.  A batch is a table of changes
``(op, doc_id, text, source, lang)`` with ``op`` one of ``upsert`` and
``delete``, counted under one tokenizer version.  Committing it

* looks up the counts that its documents have now (the latest row of the
  ledger for ``(tokenizer, doc_id)``),
* writes the new ledger rows of its documents, and
* writes signed sums per (source, language, tokenizer): minus what was
  counted before, plus what is counted now.

Totals are the sums of the signed sums over all batches, so no batch rereads
the corpus and revised or deleted documents leave no trace.  A batch is
committed under its id: its files are written to a folder of their own attempt,
and the batch counts from the moment its marker row names that attempt.
Committing an id again changes nothing, and files of an attempt that broke off
are never read.

Defined results: null or empty texts count 0 tokens and 1 document; a null
source or language is a group of its own; of rows that repeat a ``doc_id`` in
one batch the one with the largest content hash counts; a delete of an unknown
document and rows with a null ``doc_id`` change nothing; an empty batch
commits and changes nothing; further columns are ignored.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dichot.llm.spark import ready
from dichot.llm.text import slices
from dichot.llm.tokens import token_ids

LEDGER = "seq long, op string, doc_id long, source string, lang string, tokenizer string, n_tokens long"
SUMS = "source string, lang string, tokenizer string, n_docs long, n_tokens long"
MARKS = "seq long, batch_id string, attempt string"


def _counted(path: str, ranks: str | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = token_ids(path, ranks)
        for batch in batches:
            for part in slices(batch, "text"):
                n = [len(x) for x in tokens.ids(part.column("text"))]
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in ("op", "doc_id", "source", "lang")), pa.array(n, pa.int64()), part.column("digest")],
                    names=["op", "doc_id", "source", "lang", "n_tokens", "digest"])
    return run


class TokenRollup:
    """A rollup store under ``folder``, which all executors share."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder.rstrip("/")

    def _read(self, schema: str, path: str) -> DataFrame:
        return self.spark.read.schema(schema).parquet(path)

    def _exists(self, path: str) -> bool:
        there = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return there.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(there)

    def marks(self) -> list:
        """Committed batches in order, one per id."""
        if not self._exists(f"{self.folder}/marks"):
            return []
        rows = self._read(MARKS, f"{self.folder}/marks").orderBy("seq", "attempt").collect()
        first: dict[str, object] = {}
        for r in rows:
            first.setdefault(r["batch_id"], r)
        return list(first.values())

    def _parts(self, kind: str, schema: str) -> DataFrame:
        paths = [f"{self.folder}/{kind}/{m['attempt']}" for m in self.marks()]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def current(self) -> DataFrame:
        """The counted documents: ``doc_id, source, lang, tokenizer, n_tokens``."""
        last = self._parts("ledger", LEDGER).groupBy("tokenizer", "doc_id").agg(
            F.max_by(F.struct("op", "source", "lang", "n_tokens"), "seq").alias("row"))
        return last.where("row.op = 'upsert'").select("doc_id", "row.source", "row.lang", "tokenizer", "row.n_tokens")

    def totals(self) -> DataFrame:
        """``source, lang, tokenizer, n_docs, n_tokens`` of all committed batches."""
        sums = self._parts("sums", SUMS).groupBy("source", "lang", "tokenizer").agg(
            F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))
        return sums.where("n_docs <> 0 or n_tokens <> 0")

    def commit(self, batch_id: str, changes: DataFrame, tokenizer: str, path: str, ranks: str | None = None) -> bool:
        """Apply a batch once; False if its id is committed already."""
        marks = self.marks()
        if any(m["batch_id"] == batch_id for m in marks):
            return False
        ready(changes)
        seq, attempt = len(marks) + 1, uuid.uuid4().hex
        told = changes.where("doc_id is not null").select(
            F.col("op").cast("string").alias("op"), F.col("doc_id").cast("long").alias("doc_id"),
            F.when(F.col("op") == "upsert", F.col("text")).alias("text"), F.col("source").cast("string").alias("source"),
            F.col("lang").cast("string").alias("lang"), F.xxhash64("op", "text", "source", "lang").alias("digest"))
        rows = told.mapInArrow(_counted(path, ranks), "op string, doc_id long, source string, lang string, n_tokens long, digest long")
        one = rows.groupBy("doc_id").agg(F.max_by(F.struct("op", "source", "lang", "n_tokens"), "digest").alias("row"))
        ledger = one.select(F.lit(seq).cast("long").alias("seq"), "row.op", "doc_id", "row.source", "row.lang",
                            F.lit(tokenizer).alias("tokenizer"), "row.n_tokens")
        ledger.write.parquet(f"{self.folder}/ledger/{attempt}")
        now = self._read(LEDGER, f"{self.folder}/ledger/{attempt}")
        before = self.current().where(F.col("tokenizer") == tokenizer).join(now.select("doc_id"), "doc_id", "left_semi")
        signed = reduce(DataFrame.unionByName, [
            before.select("source", "lang", F.lit(-1).alias("d"), (-F.col("n_tokens")).alias("t")),
            now.where("op = 'upsert'").select("source", "lang", F.lit(1).alias("d"), F.col("n_tokens").alias("t"))])
        sums = signed.groupBy("source", "lang").agg(F.sum("d").alias("n_docs"), F.sum("t").alias("n_tokens")).select(
            "source", "lang", F.lit(tokenizer).alias("tokenizer"), "n_docs", "n_tokens")
        sums.write.parquet(f"{self.folder}/sums/{attempt}")
        mark = self.spark.createDataFrame([(seq, batch_id, attempt)], MARKS).coalesce(1)
        mark.write.mode("append").parquet(f"{self.folder}/marks")
        return True
