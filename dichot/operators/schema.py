"""Schema and type operators.

The R scripts re-infer column types from content and rebuild factors after
every CSV round trip.  Here the type decision is one aggregate job (T01) and
the result is a fixed ``StructType``; factor levels live in fitted
``StringIndexerModel`` stages.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import OneHotEncoder, StringIndexer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dichot.operators.profile import NUMERIC, numeric_columns, string_columns

# A number as R's as.numeric reads it after trimming: decimal or scientific
NUMBER_PATTERN = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
MAX_LEVELS = 10_000


def _is_number(c) -> F.Column:
    return F.trim(c).rlike(NUMBER_PATTERN)


def sniff_table(df: DataFrame, cols: Sequence[str] | None = None,
                extras: Sequence[str] = (".", "NA", "")) -> DataFrame:
    """T01 as a table: ``(column_name, n_bad, n_good, is_numeric)`` from one aggregate.

    ``all.is.numeric(x, extras=c('.', 'NA'))``: nulls, blanks and the extras
    do not count against a column; a column with no number stays text.
    """
    cols = list(cols or string_columns(df))
    aggs = []
    for c in cols:
        v = F.trim(F.col(c))
        ignorable = v.isNull() | v.isin(*extras)
        aggs.append(F.count_if(~ignorable & ~_is_number(F.col(c))).alias(c + "__bad"))
        aggs.append(F.count_if(~ignorable & _is_number(F.col(c))).alias(c + "__good"))
    one = df.agg(*aggs)
    structs = [F.struct(F.lit(c).alias("column_name"), F.col(c + "__bad").cast("long").alias("n_bad"),
                        F.col(c + "__good").cast("long").alias("n_good"),
                        ((F.col(c + "__bad") == 0) & (F.col(c + "__good") > 0)).alias("is_numeric"))
               for c in cols]
    return one.select(F.explode(F.array(*structs)).alias("_r")).select("_r.*")


def sniff_numeric(df: DataFrame, cols: Sequence[str] | None = None,
                  extras: Sequence[str] = (".", "NA", "")) -> list[str]:
    """Names of the text columns in which every value parses as a number."""
    cols = list(cols or string_columns(df))
    if not cols:
        return []
    return [r["column_name"] for r in sniff_table(df, cols, extras).collect() if r["is_numeric"]]


def to_numeric(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Text to double; anything that is not a number becomes null.

    The regex guard keeps Spark and SQL engines in step (``try_cast('3d')``
    is 3.0 in Spark).
    """
    repl = {c: F.when(_is_number(F.col(c)), F.trim(F.col(c)).cast("double"))
            for c in cols}
    return df.withColumns(repl)


def convert_numeric_columns(df: DataFrame, extras=(".", "NA", "")) -> tuple[DataFrame, list[str]]:
    """T01 + T04: sniff once, then cast all numeric-looking text columns in one projection."""
    found = sniff_numeric(df, extras=extras)
    return to_numeric(df, found), found


def columns_by_type(df: DataFrame, categorical: Sequence[str] = ()) -> dict:
    """Columns split into numeric / integer / character / factor."""
    categorical = set(categorical)
    out = {"numeric": [], "integer": [], "character": [], "factor": [], "other": []}
    for f in df.schema.fields:
        if f.name in categorical:
            out["factor"].append(f.name)
        elif isinstance(f.dataType, (T.IntegerType, T.LongType, T.ShortType, T.ByteType)):
            out["integer"].append(f.name)
        elif isinstance(f.dataType, NUMERIC):
            out["numeric"].append(f.name)
        elif isinstance(f.dataType, T.StringType):
            out["character"].append(f.name)
        else:
            out["other"].append(f.name)
    return out


def column_classes(df: DataFrame) -> DataFrame:
    """``(column_name, type)`` of every column, from the schema (no job)."""
    rows = [(f.name, f.dataType.simpleString()) for f in df.schema.fields]
    return df.sparkSession.createDataFrame(rows, "column_name string, type string")


def cast_columns(df: DataFrame, cols: Sequence[str], to: str = "double") -> DataFrame:
    """``as.numeric(as.character(x))`` as one projection of ``try_cast``."""
    return df.withColumns({c: F.expr(f"try_cast(`{c}` as {to})") for c in cols})


def factor_indexer(cols: Sequence[str], order: str = "alphabetAsc",
                   handle_invalid: str = "keep", suffix: str = "_idx") -> StringIndexer:
    """``as.factor`` for many columns: level ids ordered like R (alphabetical)."""
    return StringIndexer(inputCols=list(cols), outputCols=[c + suffix for c in cols],
                         stringOrderType=order, handleInvalid=handle_invalid)


def is_factor(df: DataFrame, col: str) -> bool:
    """A column is a factor when it carries nominal ML metadata."""
    meta = df.schema[col].metadata or {}
    attr = meta.get("ml_attr", {})
    return attr.get("type") == "nominal"


def levels(df: DataFrame, col: str, max_levels: int = MAX_LEVELS) -> list:
    """Sorted distinct non-null values (bounded count)."""
    rows = (df.filter(F.col(col).isNotNull()).select(col).distinct().orderBy(col)
              .limit(max_levels + 1).collect())
    if len(rows) > max_levels:
        raise ValueError(f"{col} has more than {max_levels} levels")
    return [r[0] for r in rows]


def levels_many(df: DataFrame, cols: Sequence[str], max_levels: int = MAX_LEVELS) -> dict:
    """Levels of several columns in one distributed job (melt, distinct, bound)."""
    cols = list(cols)
    if not cols:
        return {}
    long = (df.select(*[F.col(c).cast("string").alias(c) for c in cols])
              .unpivot([], cols, "column_name", "value")
              .filter(F.col("value").isNotNull()).distinct())
    bound = max_levels * len(cols)
    rows = long.limit(bound + 1).collect()  # one job; never more than the bound reaches the driver
    out = {c: [] for c in cols}
    for r in rows:
        out[r["column_name"]].append(r["value"])
    too_many = [c for c, v in out.items() if len(v) > max_levels]
    if too_many or len(rows) > bound:
        raise ValueError(f"too many levels in {too_many or cols}")
    for c in cols:
        t = df.schema[c].dataType
        vals = out[c]
        if isinstance(t, (T.IntegerType, T.LongType, T.ShortType, T.ByteType)):
            vals = sorted(int(v) for v in vals)
        elif isinstance(t, (T.FloatType, T.DoubleType)):
            vals = sorted(float(v) for v in vals)
        else:
            vals = sorted(vals)
        out[c] = vals
    return out


def contrast_table(df: DataFrame, col: str, max_levels: int = 1000) -> DataFrame:
    """Treatment contrasts ``contrasts(x)`` in long form.

    ``(level, dummy, value)``: one dummy per non-base level, base = first
    level in alphabetical order.  Size is levels x (levels-1), checked.
    """
    lv = levels(df, col, max_levels)
    dummies = [str(v) for v in lv[1:]]
    lv_df = (df.filter(F.col(col).isNotNull()).select(F.col(col).cast("string").alias("level"))
               .distinct())
    if not dummies:
        return lv_df.select("level", F.lit(None).cast("string").alias("dummy"),
                            F.lit(None).cast("int").alias("value")).limit(0)
    return (lv_df.withColumn("dummy", F.explode(F.array(*[F.lit(d) for d in dummies])))
                 .withColumn("value", (F.col("level") == F.col("dummy")).cast("int")))


def dummy_expand(df: DataFrame, cols: Sequence[str], full_rank: bool = False,
                 sep: str = ".", level_map: dict | None = None, keep: bool = False) -> DataFrame:
    """``dummyVars(~., fullRank=F)``: one 0/1 column per level, null stays null.

    Levels come from one job over all columns (``levels_many``) unless given.
    """
    cols = list(cols)
    level_map = level_map or levels_many(df, cols)
    new = {}
    for c in cols:
        lv = level_map[c][1:] if full_rank else level_map[c]
        for v in lv:
            new[f"{c}{sep}{v}"] = F.when(F.col(c).isNull(), F.lit(None).cast("double")) \
                                   .otherwise((F.col(c) == F.lit(v)).cast("double"))
    out = df.withColumns(new)
    return out if keep else out.drop(*cols)


def onehot_stage(index_cols: Sequence[str], drop_last: bool = False) -> OneHotEncoder:
    """T09 as a Pipeline stage over indexed columns."""
    return OneHotEncoder(inputCols=list(index_cols), outputCols=[c + "_vec" for c in index_cols],
                         dropLast=drop_last, handleInvalid="keep")


def align_types(df: DataFrame, reference: T.StructType, cols: Sequence[str] | None = None) -> DataFrame:
    """Cast the columns of a scoring frame to the training schema."""
    cols = list(cols or [f.name for f in reference.fields if f.name in df.columns])
    return df.select(*[F.col(c).cast(reference[c].dataType).alias(c) if c in cols else F.col(c)
                       for c in df.columns])


def rename(df: DataFrame, mapping: dict) -> DataFrame:
    """``names(df)[..] <- ..``."""
    return df.withColumnsRenamed(mapping)


def structure(df: DataFrame, order_cols: Sequence[str], n_first: int = 3) -> DataFrame:
    """``str(df)``: column, type and the first values in key order."""
    head = df.orderBy(*order_cols).limit(n_first)
    aggs = [F.concat_ws(", ", F.collect_list(F.col(f.name).cast("string"))).alias(f.name)
            for f in df.schema.fields]
    one = head.agg(*aggs)
    structs = [F.struct(F.lit(f.name).alias("column_name"),
                        F.lit(f.dataType.simpleString()).alias("type"),
                        F.col(f.name).alias("first_values")) for f in df.schema.fields]
    return one.select(F.explode(F.array(*structs)).alias("_r")).select("_r.*")


def shape(df: DataFrame) -> tuple[int, int]:
    """``dim(df)``."""
    return df.count(), len(df.columns)


__all__ = [n for n in dir() if not n.startswith("_")] + ["numeric_columns", "string_columns"]
