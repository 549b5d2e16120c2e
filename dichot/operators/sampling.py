"""Reproducible sampling and partitioning (stratified split, downsample, folds).

Every random choice is a function of ``(seed, key)`` through
:mod:`dichot.functions.hashing`, so a split is the same on any cluster size
and can be repeated in SQL: inside each class, rows are ordered by
``(u, key)`` and the first ``quota`` rows are taken.

At scale nothing is ranked over a whole class.  Rows are counted per
(class, 16-bit hash bucket) -- at most 65,536 rows per class reach the
driver -- which fixes the boundary bucket of every class; whole buckets below
it are in, above it out, and only the rows of the boundary bucket (about
1/65,536 of the class) are ranked.  The result is a boolean column computed
by a projection, so the big frame is never shuffled.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dichot.functions.hashing import hash_bucket16, hash_uniform

_U, _B = "_dichot_u", "_dichot_b"
MAX_CLASSES = 1000
BROADCAST_ROWS = 1_000_000


def uniform_column(key_cols: Sequence[str], seed: int) -> Column:
    """Reproducible uniform(0,1) probe column (``runif`` by key)."""
    return hash_uniform(seed, list(key_cols))


def _lex_le(cols: Sequence[str], values: Sequence) -> Column:
    """(c1, c2, ...) <= (v1, v2, ...) lexicographically."""
    expr = None
    for i in reversed(range(len(cols))):
        eq_prefix = F.lit(True)
        for j in range(i):
            eq_prefix = eq_prefix & (F.col(cols[j]) == F.lit(values[j]))
        term = eq_prefix & ((F.col(cols[i]) < F.lit(values[i])) if i < len(cols) - 1
                            else (F.col(cols[i]) <= F.lit(values[i])))
        expr = term if expr is None else (expr | term)
    return expr


def _class_eq(label_col: str, value) -> Column:
    return F.col(label_col).eqNullSafe(F.lit(value))


def _with_hash(df: DataFrame, key_cols, seed) -> DataFrame:
    return (df.withColumn(_U, hash_uniform(seed, list(key_cols)))
              .withColumn(_B, hash_bucket16(seed, list(key_cols))))


def class_counts(df: DataFrame, label_col: str) -> dict:
    rows = df.groupBy(label_col).count().collect()
    if len(rows) > MAX_CLASSES:
        raise ValueError(f"{label_col} has more than {MAX_CLASSES} classes")
    return {r[label_col]: r["count"] for r in rows}


def _bucket_counts(hashed: DataFrame, label_col: str):
    """Rows per (class, 16-bit bucket): at most 65,536 rows per class, as pandas (Arrow)."""
    pdf = hashed.groupBy(F.col(label_col).alias("_cls"), _B).count().toPandas()
    if pdf["_cls"].nunique(dropna=False) > MAX_CLASSES:
        raise ValueError(f"{label_col} has more than {MAX_CLASSES} classes")
    return pdf.sort_values(["_cls", _B], na_position="first")


def _bucket_table(hashed: DataFrame, label_col: str) -> dict:
    pdf = _bucket_counts(hashed, label_col)
    table: dict = {}
    for cls, g in pdf.groupby("_cls", dropna=False, sort=False):
        key = None if (isinstance(cls, float) and cls != cls) else cls
        if hasattr(key, "item"):
            key = key.item()
        table[key] = (g[_B].to_numpy(), g["count"].to_numpy())
    return table


def select_flag(df: DataFrame, label_col: str, key_cols: Sequence[str], quota, seed: int,
                name: str = "selected") -> DataFrame:
    """Add boolean ``name``: the row is among the ``quota(n_c)`` first rows of
    its class in ``(u, key)`` order.  ``quota`` maps (class, n_c) -> count.
    """
    key_cols = list(key_cols)
    hashed = _with_hash(df, key_cols, seed)
    table = _bucket_table(hashed, label_col)
    plan = {}  # class -> ("all"|"none"|(bucket, need))
    for cls, (buckets, counts) in table.items():
        n_c = int(counts.sum())
        k = int(quota(cls, n_c))
        if k <= 0:
            plan[cls] = "none"
            continue
        if k >= n_c:
            plan[cls] = "all"
            continue
        cum = np.cumsum(counts)
        i = int(np.searchsorted(cum, k, side="left"))   # first bucket reaching k rows
        before = int(cum[i - 1]) if i > 0 else 0
        plan[cls] = (int(buckets[i]), k - before)
    boundary_classes = [c for c, p in plan.items() if isinstance(p, tuple)]
    cuts = {}
    if boundary_classes:
        cond = None
        for c in boundary_classes:
            t = _class_eq(label_col, c) & (F.col(_B) == plan[c][0])
            cond = t if cond is None else (cond | t)
        w = Window.partitionBy(label_col).orderBy(_U, *key_cols)
        need = F.coalesce(*[F.when(_class_eq(label_col, c), F.lit(plan[c][1]))
                            for c in boundary_classes], F.lit(None).cast("int"))
        ranked = (hashed.filter(cond)
                        .select(label_col, _U, *key_cols)
                        .withColumn("_rn", F.row_number().over(w))
                        .filter(F.col("_rn") == need))
        for r in ranked.collect():
            cuts[r[label_col]] = [r[_U]] + [r[k] for k in key_cols]
    flag = F.lit(False)
    for cls, p in plan.items():
        if p == "none":
            continue
        if p == "all":
            flag = flag | _class_eq(label_col, cls)
            continue
        b, _ = p
        inside = (F.col(_B) < b) | ((F.col(_B) == b) & _lex_le([_U] + key_cols, cuts[cls]))
        flag = flag | (_class_eq(label_col, cls) & inside)
    return hashed.withColumn(name, flag).drop(_U, _B)


def stratified_flag(df: DataFrame, label_col: str, key_cols: Sequence[str], p: float,
                    seed: int, name: str = "in_train") -> DataFrame:
    """``createDataPartition(y, p)`` -- ceil(p * n_c) rows per class."""
    return select_flag(df, label_col, key_cols, lambda _c, n: math.ceil(p * n), seed, name)


def stratified_split(df: DataFrame, label_col: str, key_cols: Sequence[str], p: float,
                     seed: int) -> tuple[DataFrame, DataFrame]:
    """(train, test) pair; the test part is the anti side of the flag."""
    flagged = stratified_flag(df, label_col, key_cols, p, seed, "_in").persist()
    return (flagged.filter("_in").drop("_in"), flagged.filter("NOT _in").drop("_in"))


def downsample(df: DataFrame, label_col: str, key_cols: Sequence[str], seed: int) -> DataFrame:
    """Every class cut to the size of the smallest class, without replacement."""
    counts = class_counts(df, label_col)
    m = min(counts.values())
    return select_flag(df, label_col, key_cols, lambda _c, n: min(n, m), seed, "_keep") \
        .filter("_keep").drop("_keep")


def kfold(df: DataFrame, label_col: str, key_cols: Sequence[str], k: int, seed: int,
          name: str = "fold") -> DataFrame:
    """Class-stratified fold id in 0..k-1, sizes within one of each other.

    fold = (rank of the row inside its class in (u, key) order - 1) mod k.
    The rank is the count of the earlier hash buckets (a broadcast table of at
    most 65,536 rows per class) plus a row number inside the bucket, so the
    window is partitioned by (class, bucket), never by class alone.
    """
    key_cols = list(key_cols)
    hashed = _with_hash(df, key_cols, seed)
    # rows before each (class, bucket): a window over the bucket counts, which
    # hold at most 65,536 rows per class
    counts = hashed.groupBy(F.col(label_col).alias("_cls"), _B).count()
    before = Window.partitionBy("_cls").orderBy(_B).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_cls", _B, F.coalesce(F.sum("count").over(before), F.lit(0))
                            .cast("long").alias("_before"))
    n_classes = counts.select("_cls").distinct().count()
    if n_classes > MAX_CLASSES:
        raise ValueError(f"{label_col} has more than {MAX_CLASSES} classes")
    # broadcast only while classes x 65,536 stays small
    side = F.broadcast(offsets) if n_classes * 65536 <= BROADCAST_ROWS else offsets
    w = Window.partitionBy(label_col, _B).orderBy(_U, *key_cols)
    out = (hashed.withColumn("_rn", F.row_number().over(w))
                 .join(side,
                       F.col(label_col).eqNullSafe(F.col("_cls")) & (hashed[_B] == side[_B]))
                 .withColumn(name, ((F.col("_before") + F.col("_rn") - 1) % k).cast("int")))
    return out.drop("_rn", "_cls", "_before", _U, _B)


def repeated_kfold(df: DataFrame, label_col: str, key_cols: Sequence[str], k: int,
                   repeats: int, seed: int) -> DataFrame:
    """One fold column per repeat (``fold_1`` ... ``fold_r``), seed + r.

    All repeats are ranked together: keys and label, once for each repeat, are
    numbered inside (repeat, class, hash bucket), and the rows of earlier
    buckets are added from one table of counts.  The folds come back to the
    rows in one join on the key, so the plan is the same for any number of
    repeats.  Keys must be unique, as for :func:`kfold`.
    """
    key_cols = list(key_cols)
    ids = [f"_k{i}" for i in range(len(key_cols))]
    draws = F.array(*[F.struct(F.lit(r).alias("r"), hash_uniform(seed + r, key_cols).alias("u"),
                               hash_bucket16(seed + r, key_cols).alias("b")) for r in range(1, repeats + 1)])
    long = df.select(*[F.col(c).alias(i) for c, i in zip(key_cols, ids)], F.col(label_col).alias("_cls"),
                     F.explode(draws).alias("_d")).select(*ids, "_cls", "_d.*")
    counts = long.groupBy("r", "_cls", "b").count()
    before = Window.partitionBy("r", "_cls").orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(F.col("r").alias("_r"), F.col("_cls").alias("_c"), F.col("b").alias("_b"),
                            F.coalesce(F.sum("count").over(before), F.lit(0)).cast("long").alias("_before"))
    w = Window.partitionBy("r", "_cls", "b").orderBy("u", *ids)
    ranked = (long.withColumn("_rn", F.row_number().over(w))
                  .join(offsets, (F.col("r") == F.col("_r")) & F.col("_cls").eqNullSafe(F.col("_c")) & (F.col("b") == F.col("_b")))
                  .withColumn("_fold", ((F.col("_before") + F.col("_rn") - 1) % k).cast("int")))
    folds = ranked.groupBy(*ids).agg(*[F.max(F.when(F.col("r") == r, F.col("_fold"))).alias(f"fold_{r}")
                                       for r in range(1, repeats + 1)])
    on = None
    for c, i in zip(key_cols, ids):
        same = df[c].eqNullSafe(folds[i])
        on = same if on is None else on & same
    return df.join(folds, on).drop(*ids)
