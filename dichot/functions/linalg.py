"""Distributed weighted Gram sums and the small dense algebra done on the driver.

Every partition turns its rows into a few p x p partial sums with numpy
(Arrow batches, no per-row Python) and emits one row; the partials are
summed by ``Summarizer`` -- a regular partial/final aggregate -- so only one
vector of length ~p^2 ever reaches the driver.  p is the number of model
terms (tens to a few hundred), never the number of rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def sum_partials(df: DataFrame, partial_fn, length: int) -> np.ndarray:
    """Run ``partial_fn(pandas batch) -> 1-d array`` per partition and add them up."""

    def per_partition(batches):
        acc = None
        for pdf in batches:
            if pdf.empty:
                continue
            part = partial_fn(pdf)
            acc = part if acc is None else acc + part
        if acc is not None:
            yield pd.DataFrame({"v": [acc.astype(np.float64).tolist()]})

    return add_vectors(df.mapInPandas(per_partition, "v array<double>"), length)


#: groups of partitions whose vectors are added before the last task adds the groups
ADD_GROUPS = 64
#: bytes of all vectors together that the driver adds by itself
DRIVER_BYTES = 64 << 20


def add_vectors(partials: DataFrame, length: int, partitions: int | None = None) -> np.ndarray:
    """The sum of the arrays ``v``, one a partition.  The last task adds at most
    ``ADD_GROUPS`` vectors however many partitions there are: unless it is known
    that there are no more, groups of partitions are added first.  Few small
    vectors are added by the driver, which spares each short pass a shuffle."""
    if partitions is not None and 8 * length * partitions <= DRIVER_BYTES:
        total = np.zeros(length)
        for chunk in partials.select("v").toArrow().column("v").chunks:
            total += chunk.flatten().to_numpy(zero_copy_only=False).reshape(len(chunk), length).sum(0)
        return total

    def added(column):
        return Summarizer.metrics("sum", "count").summary(column).alias("s")
    vectors = partials.select(array_to_vector("v").alias("v"))
    if partitions is None or partitions > ADD_GROUPS:
        groups = vectors.groupBy((F.spark_partition_id() % ADD_GROUPS).alias("g")).agg(added(F.col("v")))
        vectors = groups.where("s.count > 0").select(F.col("s.sum").alias("v"))
    # grouped by a constant: no vectors give no row, where a plain sum would fail
    row = vectors.groupBy(F.lit(0).alias("all")).agg(added(F.col("v"))).first()
    return row["s"]["sum"].toArray() if row is not None else np.zeros(length)


def stack_rows(series: pd.Series, width: int) -> np.ndarray:
    """Array column of a pandas batch to an (n, width) float matrix."""
    if len(series) == 0:
        return np.zeros((0, width))
    return np.stack(series.to_numpy()).astype(np.float64).reshape(len(series), width)


def x_cols(p: int) -> list[str]:
    """Names of the design columns of a model matrix frame (one double each,
    so Arrow ships plain columns and no per-row array objects)."""
    return [f"x_{i}" for i in range(p)]


def design_block(pdf: pd.DataFrame, p: int) -> np.ndarray:
    """(n, p) float matrix from the ``x_i`` columns of a pandas batch."""
    if p == 0:
        return np.zeros((len(pdf), 0))
    return pdf[x_cols(p)].to_numpy(dtype=np.float64)


def weighted_gram(df: DataFrame, x_col: str, p: int, weight_col: str | None = None,
                  intercept: bool = True) -> np.ndarray:
    """X'WX of an array column (intercept column first when asked)."""
    k = p + (1 if intercept else 0)

    def partial(pdf):
        x = stack_rows(pdf[x_col], p)
        if intercept:
            x = np.hstack([np.ones((len(x), 1)), x])
        w = pdf[weight_col].to_numpy(dtype=np.float64) if weight_col else np.ones(len(x))
        return (x.T * w) @ x

    return sum_partials(df.select(x_col, *([weight_col] if weight_col else [])),
                        lambda pdf: partial(pdf).ravel(), k * k).reshape(k, k)


def aliased_columns(gram: np.ndarray, tol: float = 1e-7) -> list[int]:
    """Columns that are linear combinations of earlier ones (R's aliased terms).

    Sequential Cholesky on the Gram matrix: a column whose residual sum of
    squares, after projection on the kept columns, is below ``tol`` times its
    own is dropped, keeping the first of a dependent set as ``lm.fit`` does.
    """
    k = gram.shape[0]
    kept: list[int] = []
    dropped: list[int] = []
    for j in range(k):
        if not kept:
            if gram[j, j] > 0:
                kept.append(j)
            else:
                dropped.append(j)
            continue
        g_kk = gram[np.ix_(kept, kept)]
        g_kj = gram[kept, j]
        try:
            coef = np.linalg.solve(g_kk, g_kj)
        except np.linalg.LinAlgError:
            coef = np.linalg.lstsq(g_kk, g_kj, rcond=None)[0]
        resid = gram[j, j] - g_kj @ coef
        if gram[j, j] <= 0 or resid <= tol * gram[j, j]:
            dropped.append(j)
        else:
            kept.append(j)
    return dropped


def cov_to_corr(v: np.ndarray) -> np.ndarray:
    d = np.sqrt(np.diag(v))
    return v / np.outer(d, d)


def logdet(m: np.ndarray) -> float:
    sign, val = np.linalg.slogdet(m)
    return float(val) if sign > 0 else float("nan")
