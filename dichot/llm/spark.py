"""Small Spark helpers shared by the text operators."""

from __future__ import annotations

import math
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dichot.session import ensure_checkpoint_dir, ship_package


def ready(df: DataFrame) -> SparkSession:
    """Make the package importable in tasks; return the session."""
    ship_package(df.sparkSession)
    return df.sparkSession


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


#: rows of whole texts that are handed to a Python worker at once
TEXT_ROWS = 512
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def written(df: DataFrame, name: str, batch_rows: int | None = None) -> DataFrame:
    """Cut the lineage: write ``df`` to the shared checkpoint folder as Parquet
    and read it back.  The files survive the loss of any executor.  Python
    workers get at most ``batch_rows`` rows at once, where given: of whole texts,
    the session's 10,000 hold tens of MB in the JVM and again in each worker."""
    spark, path = df.sparkSession, scratch(df.sparkSession, name)
    before = spark.conf.get(_BATCH)
    if batch_rows is not None and not 0 < int(before) <= batch_rows:
        spark.conf.set(_BATCH, str(batch_rows))
    try:
        df.write.parquet(path)
    finally:
        if spark.conf.get(_BATCH) != before:
            spark.conf.set(_BATCH, before)
    out = spark.read.schema(df.schema).parquet(path)
    out.written_to = path
    return out


def freed(*tables: DataFrame | None) -> None:
    """Delete the files of :func:`written` tables that no later plan reads."""
    for df in tables:
        if df is not None:
            spark = df.sparkSession
            path = spark._jvm.org.apache.hadoop.fs.Path(df.written_to)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def parts(spark: SparkSession, amount: float, share: float) -> int:
    """How many parts of about ``share`` make up ``amount``; no fewer than the
    session's shuffle partitions, so that small inputs use all cores."""
    return max(shuffle_partitions(spark), math.ceil((amount or 0) / share))


def text_bytes(docs: DataFrame, column: str = "text") -> int:
    return docs.agg(F.sum(F.octet_length(column))).first()[0] or 0


def checked_broadcast(df: DataFrame, rows: int, limit: int) -> DataFrame:
    """``df`` with a broadcast hint if its counted ``rows`` are within ``limit``;
    otherwise unchanged, and the join shuffles."""
    return F.broadcast(df) if rows <= limit else df


def per_group(work, *settings):
    """``work(*settings, group)`` in the form ``applyInArrow`` takes."""
    def run(group: pa.Table) -> pa.Table:
        return work(*settings, group)
    return run


def per_pair(work, *settings):
    """``work(*settings, left, right)`` in the form a cogrouped ``applyInArrow`` takes."""
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        return work(*settings, left, right)
    return run
