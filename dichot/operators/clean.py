"""Missing-data and cleaning operators.

Imputation statistics are *fitted*: they are computed on the training
frame and kept, so a scoring file is filled with training statistics (the
reference's scoring job used the scoring file's own mean, defect D14; that
behaviour is available with ``fit_on="self"``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import Imputer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dichot.operators.quantiles import select_quantiles
from dichot.operators.profile import column_stats, melt, nan_to_null, quoted, string_columns


def replace_sentinel(df: DataFrame, sentinel: str = "NULL", replacement: str = "",
                     cols: Sequence[str] | None = None) -> DataFrame:
    """``x[which(x == "NULL")] <- ""`` over every text column, one projection."""
    cols = list(cols or string_columns(df))
    return df.withColumns({c: F.when(F.col(quoted(c)) == sentinel, F.lit(replacement)).otherwise(F.col(quoted(c)))
                           for c in cols})


def blank_to_null(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Blank text to NA, as ``read.csv(na.strings=c(""))`` does."""
    cols = list(cols or string_columns(df))
    return df.withColumns({c: F.when(F.trim(F.col(quoted(c))) == "", F.lit(None)).otherwise(F.col(quoted(c)))
                           for c in cols})


def fill_constant(df: DataFrame, cols: Sequence[str], value=0) -> DataFrame:
    """``x[is.na(x)] <- 0`` for a column list."""
    return df.fillna(value, subset=list(cols))


def column_minima(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Minima of the columns about to be zero-filled (the guard)."""
    return column_stats(df, cols, "min")


def fit_imputer(df: DataFrame, cols: Sequence[str], strategy: str = "mean",
                exact: bool = True) -> dict:
    """Fitted fill values per column.

    ``mean`` is one aggregate.  ``median`` is exact (R's type 7 via
    two-pass selection) unless ``exact=False`` (``percentile_approx``).
    ``mode`` is the most frequent value, ties to the smallest.
    """
    cols = list(cols)
    if strategy == "mean":
        row = df.agg(*[F.avg(nan_to_null(F.col(quoted(c)))).alias(c) for c in cols]).collect()[0]
        return {c: row[c] for c in cols}
    if strategy == "median":
        if exact:
            return {c: q[0.5] for c, q in select_quantiles(df, cols, [0.5]).items() if q}
        q = melt(df, cols, "double").groupBy("column_name").agg(F.percentile_approx("value", 0.5, 10000).alias("m"))
        return {r["column_name"]: r["m"] for r in q.collect()}
    if strategy == "mode":
        long = melt(df, cols, "string").filter(F.col("value").isNotNull())
        counts = long.groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n"))
        # most frequent value, ties to the smallest text
        top = counts.groupBy("column_name").agg(
            F.min_by("value", F.struct((-F.col("n")).alias("k"), F.col("value"))).alias("value"))
        types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
        out = {c: None for c in cols}
        for r in top.collect():
            v, t = r["value"], types[r["column_name"]]
            out[r["column_name"]] = (int(v) if t in ("int", "bigint", "smallint", "tinyint")
                                     else float(v) if t in ("double", "float") else v)
        return out
    raise ValueError(strategy)


def apply_imputer(df: DataFrame, values: dict) -> DataFrame:
    """Fill nulls and NaN with fitted values (one projection)."""
    types = {f.name: f.dataType for f in df.schema.fields}

    def known(c):
        x = F.col(quoted(c))
        return nan_to_null(x) if isinstance(types[c], (T.FloatType, T.DoubleType)) else x
    return df.withColumns({c: F.coalesce(known(c), F.lit(v)) for c, v in values.items()
                           if v is not None})


def impute(df: DataFrame, cols: Sequence[str], strategy: str = "mean",
           fit_on: DataFrame | str | None = None) -> tuple[DataFrame, dict]:
    """Impute ``cols`` of ``df`` with statistics fitted on ``fit_on``.

    ``fit_on=None`` or ``"self"`` fits on ``df`` itself.
    """
    source = df if fit_on is None or (isinstance(fit_on, str) and fit_on == "self") else fit_on
    values = fit_imputer(source, cols, strategy)
    return apply_imputer(df, values), values


def imputer_stage(cols: Sequence[str], strategy: str = "mean") -> Imputer:
    """C02/C05 as a ``pyspark.ml`` stage (median there is approximate)."""
    return Imputer(inputCols=list(cols), outputCols=list(cols), strategy=strategy)


def recode_binary(df: DataFrame, col: str, positive, name: str | None = None) -> DataFrame:
    """Two-valued target to 0/1 (1 = ``positive``); NA stays NA."""
    name = name or col
    x = F.col(quoted(col))
    return df.withColumn(name, F.when(x.isNull(), F.lit(None).cast("double"))
                         .when(x == F.lit(positive), F.lit(1.0)).otherwise(F.lit(0.0)))


def label_names(df: DataFrame, col: str, names=("Reduce", "Spend"), name: str | None = None) -> DataFrame:
    """0/1 back to class names (``ifelse(y == 1, "Spend", "Reduce")``)."""
    name = name or col
    return df.withColumn(name, F.when(F.col(col) == 1, F.lit(names[1]))
                         .when(F.col(col) == 0, F.lit(names[0])))
