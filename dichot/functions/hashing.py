"""Reproducible per-row uniforms.

``rand(seed)`` depends on partitioning, so a split drawn with it cannot be
repeated on another cluster or by an SQL engine.  Here a row's uniform is a
pure function of (seed, key): the first 32 bits of ``md5("seed:key")``.
DuckDB's ``md5`` gives the same digest, so every split is oracle-checkable.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TWO_32 = 4294967296.0


def _digest(seed, key_cols) -> Column:
    parts = [F.lit(str(seed))] + [F.col(k).cast("string") if isinstance(k, str) else k.cast("string")
                                  for k in key_cols]
    return F.md5(F.concat_ws(":", *parts))


def hash_bits32(seed, key_cols) -> Column:
    """First 8 hex digits of the md5 digest as a non-negative long."""
    return F.conv(F.substring(_digest(seed, key_cols), 1, 8), 16, 10).cast("long")


def hash_uniform(seed, key_cols) -> Column:
    """Uniform in [0, 1) from (seed, key)."""
    return hash_bits32(seed, key_cols) / F.lit(TWO_32)


def hash_bucket16(seed, key_cols) -> Column:
    """Top 16 bits of the same digest: a bucket monotone in ``hash_uniform``."""
    return F.conv(F.substring(_digest(seed, key_cols), 1, 4), 16, 10).cast("int")
