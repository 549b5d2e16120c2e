"""Column profiling (A01-A21): missing values, distinct counts, summaries,
frequency and contingency tables, correlations.

Results are *long* DataFrames ``(column_name, metric...)`` rather than named
vectors printed on a console.  Every per-column loop of the R scripts becomes
one projection or one aggregate: p columns cost one job, not p jobs.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dichot.functions.stats import t_sf_two_sided
from dichot.operators.ordered import row_index, running_sums
from dichot.operators.quantiles import select_quantiles

NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType,
           T.DecimalType)


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC)]


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def quoted(name: str) -> str:
    """A column name as Spark parses it, dots and back-ticks included."""
    return "`" + name.replace("`", "``") + "`"


def nan_to_null(x: Column) -> Column:
    """``x`` as a double with NaN missing, as ``is.na`` sees it."""
    return F.nanvl(x.cast("double"), F.lit(None).cast("double"))


def _explode_single_row(row_df: DataFrame, structs) -> DataFrame:
    return row_df.select(F.explode(F.array(*structs)).alias("_r")).select("_r.*")


def melt(df: DataFrame, cols: Sequence[str], value_type: str = "string",
         id_cols: Sequence[str] = ()) -> DataFrame:
    """Wide to long: ``(id..., column_name, value)``; one row per cell."""
    cols = list(cols)
    def norm(c):
        v = F.col(quoted(c))
        if isinstance(df.schema[c].dataType, (T.FloatType, T.DoubleType)):
            v = nan_to_null(v)
            if value_type == "string":
                v = v + F.lit(0.0)  # -0.0 and 0.0 are one value
        return v.cast(value_type)
    ids = [quoted(c) for c in id_cols]
    return (df.select(*ids, *[norm(c).alias(c) for c in cols])
              .unpivot(ids, [quoted(c) for c in cols], "column_name", "value"))


# ----------------------------------------------------------------- A01-A03, A07

def missing_profile(df: DataFrame, cols: Sequence[str] | None = None,
                    sentinel: str = "NULL") -> DataFrame:
    """Nulls, blanks and a text sentinel per column in one job.

    Blank and sentinel counts follow ``which(x == "")``: null cells are not
    counted; for non-text columns they are 0.
    """
    cols = list(cols or df.columns)
    strings = set(string_columns(df))
    aggs = []
    for c in cols:
        aggs.append(F.count_if(F.col(c).isNull()).alias(f"{c}__null"))
        if c in strings:
            aggs.append(F.count_if(F.col(c) == "").alias(f"{c}__blank"))
            aggs.append(F.count_if(F.col(c) == sentinel).alias(f"{c}__sentinel"))
    one = df.agg(*aggs)
    structs = []
    for c in cols:
        blank = F.col(f"{c}__blank") if c in strings else F.lit(0).cast("long")
        sent = F.col(f"{c}__sentinel") if c in strings else F.lit(0).cast("long")
        structs.append(F.struct(F.lit(c).alias("column_name"),
                                F.col(f"{c}__null").cast("long").alias("n_null"),
                                blank.cast("long").alias("n_blank"),
                                sent.cast("long").alias("n_sentinel")))
    return _explode_single_row(one, structs)


def max_missing(profile: DataFrame) -> DataFrame:
    """The largest null / blank count over all columns (post-clean check)."""
    return profile.agg(F.max("n_null").alias("max_null"), F.max("n_blank").alias("max_blank"))


# ----------------------------------------------------------------------- A04

def distinct_profile(df: DataFrame, cols: Sequence[str] | None = None,
                     null_as_value: bool = True, approx: bool = False) -> DataFrame:
    """Distinct values per column, NA counted as a value like ``length(unique(x))``.

    Exact form melts once and groups by (column, value), then by column, so
    many exact distincts do not plan an ``Expand`` of the whole table.
    """
    cols = list(cols or df.columns)
    if approx:
        aggs = [F.approx_count_distinct(c).alias(c) for c in cols]
        nulls = [F.max(F.col(c).isNull().cast("int")).alias(c + "__hasnull") for c in cols]
        one = df.agg(*aggs, *nulls)
        structs = [F.struct(F.lit(c).alias("column_name"),
                            (F.col(c) + (F.col(c + "__hasnull") if null_as_value else F.lit(0)))
                            .cast("long").alias("n_distinct")) for c in cols]
        return _explode_single_row(one, structs)
    long = melt(df, cols)
    if not null_as_value:
        long = long.filter(F.col("value").isNotNull())
    return (long.groupBy("column_name", "value").agg(F.lit(1).alias("_x"))
                .groupBy("column_name").agg(F.count(F.lit(1)).alias("n_distinct")))


def low_cardinality(df: DataFrame, max_distinct: int, cols=None) -> list[str]:
    """Numeric columns with fewer than ``max_distinct`` values (category candidates)."""
    cols = list(cols or numeric_columns(df))
    prof = distinct_profile(df, cols).filter(F.col("n_distinct") < max_distinct)
    return sorted(r["column_name"] for r in prof.collect())


def high_cardinality(df: DataFrame, max_distinct: int, cols=None) -> list[str]:
    """P06 input: text columns with more than ``max_distinct`` values."""
    cols = list(cols or string_columns(df))
    prof = distinct_profile(df, cols).filter(F.col("n_distinct") > max_distinct)
    return sorted(r["column_name"] for r in prof.collect())


# ------------------------------------------------------------------ A05-A08

def numeric_summary(df: DataFrame, cols: Sequence[str] | None = None,
                    approx: bool = False, accuracy: int = 10000) -> DataFrame:
    """``summary(df)`` for numeric columns plus sd.

    Columns: column_name, n, n_na, min, q1, median, mean, q3, max, sd.
    Quartiles are R's type 7, exact by default (see ``select_quantiles``).
    """
    cols = list(cols or numeric_columns(df))
    aggs = []
    for c in cols:
        x = nan_to_null(F.col(quoted(c)))
        aggs += [F.count(x).alias(f"{c}__n"), F.count_if(x.isNull()).alias(f"{c}__na"),
                 F.min(x).alias(f"{c}__min"), F.max(x).alias(f"{c}__max"),
                 F.avg(x).alias(f"{c}__mean"), F.stddev_samp(x).alias(f"{c}__sd")]
    one = df.agg(*aggs)

    def stat(c, name):
        return F.col(quoted(f"{c}__{name}"))
    moments = _explode_single_row(one, [
        F.struct(F.lit(c).alias("column_name"), stat(c, "n").cast("long").alias("n"),
                 stat(c, "na").cast("long").alias("n_na"), stat(c, "min").alias("min"),
                 stat(c, "max").alias("max"), stat(c, "mean").alias("mean"),
                 stat(c, "sd").alias("sd")) for c in cols])
    probs = [0.25, 0.5, 0.75]
    if approx:
        q = (melt(df, cols, "double").groupBy("column_name")
                 .agg(F.percentile_approx("value", probs, accuracy).alias("_q"))
                 .select("column_name", F.col("_q")[0].alias("q1"), F.col("_q")[1].alias("median"),
                         F.col("_q")[2].alias("q3")))
    else:
        found = select_quantiles(df, cols, probs)
        q = df.sparkSession.createDataFrame([(c, *(found[c].get(p) for p in probs)) for c in cols],
                                            "column_name string, q1 double, median double, q3 double")
    return (moments.join(q, "column_name", "left")
                   .select("column_name", "n", "n_na", "min", "q1", "median", "mean", "q3", "max",
                           "sd"))


def column_stats(df: DataFrame, cols: Sequence[str], stat: str = "min") -> DataFrame:
    """One statistic per column, e.g. minima before a zero fill."""
    fn = {"min": F.min, "max": F.max, "mean": F.avg, "sd": F.stddev_samp}[stat]
    one = df.agg(*[fn(nan_to_null(F.col(quoted(c)))).alias(c) for c in cols])
    return _explode_single_row(one, [F.struct(F.lit(c).alias("column_name"),
                                              F.col(quoted(c)).alias(stat)) for c in cols])


# ------------------------------------------------------------------ A09-A13

def freq_table(df: DataFrame, col: str) -> DataFrame:
    """``table(x)``: counts per value, NA dropped."""
    return (df.filter(F.col(col).isNotNull()).groupBy(col)
              .agg(F.count(F.lit(1)).alias("n")))


def prop_table(df: DataFrame, col: str) -> DataFrame:
    """A10: ``prop.table(table(x))``; the total is a one-row broadcast side."""
    counts = freq_table(df, col)
    total = counts.agg(F.sum("n").alias("_total"))
    return (counts.crossJoin(F.broadcast(total))
                  .select(col, "n", (F.col("n") / F.col("_total")).alias("prop")))


def rare_event(df: DataFrame, label_col: str, positive=1, threshold: float = 0.15) -> DataFrame:
    """Share of the positive class and the rare-event flag (< 15% events)."""
    return df.agg(F.avg((F.col(label_col) == F.lit(positive)).cast("double")).alias("event_rate"),
                  F.count(F.lit(1)).alias("n")) \
             .withColumn("rare", F.col("event_rate") < threshold)


def crosstab(df: DataFrame, a: str, b: str, zero_fill: bool = True,
             max_cells: int = 1_000_000) -> DataFrame:
    """Two-way table in long form ``(a, b, n)`` with empty cells kept.

    Every level of ``a`` is paired with the levels of ``b`` (their count is
    checked first) and the counts are joined to the cells, so any level text or
    column type will do.
    """
    counts = (df.select(F.col(quoted(a)).alias("_a"), F.col(quoted(b)).alias("_b")).dropna()
                .groupBy("_a", "_b").agg(F.count(F.lit(1)).alias("n")))
    if zero_fill:
        lv_b = [r[0] for r in df.filter(F.col(quoted(b)).isNotNull()).select(F.col(quoted(b)).alias("_b"))
                .distinct().limit(max_cells + 1).collect()]
        if len(lv_b) > max_cells:
            raise ValueError("too many levels for a zero-filled crosstab")
        levels = F.array(*[F.lit(v) for v in lv_b]).cast(T.ArrayType(df.schema[b].dataType))
        cells = counts.select("_a").distinct().withColumn("_b", F.explode(levels))
        counts = cells.join(counts, ["_a", "_b"], "left").fillna(0, subset=["n"])
    return counts.select(F.col("_a").alias(a), F.col("_b").alias(b), "n")


def small_cells(table: DataFrame, min_count: int = 5) -> DataFrame:
    """Cells of a crosstab under ``min_count`` (sparse-cell check)."""
    return table.filter(F.col("n") < min_count)


def grouped_mean_sd(df: DataFrame, group_col: str, value_col: str) -> DataFrame:
    """``tapply(x, g, function(x) c(M=mean(x), SD=sd(x)))``."""
    return df.groupBy(group_col).agg(F.avg(value_col).alias("mean"),
                                     F.stddev_samp(value_col).alias("sd"),
                                     F.count(value_col).alias("n"))


def missingness_map(df: DataFrame, order_cols: Sequence[str], cols: Sequence[str],
                    n_buckets: int = 20) -> DataFrame:
    """Missing rate per (column, row bucket) along a key order."""
    idx = row_index(df.select(*order_cols, *cols), order_cols)
    n = df.count()
    bucket = F.floor((F.col("row_idx") - 1) * F.lit(n_buckets) / F.lit(max(n, 1))).cast("int")
    agg = idx.groupBy(bucket.alias("row_bucket")).agg(
        *[F.avg(F.col(c).isNull().cast("double")).alias(c) for c in cols])
    return agg.unpivot(["row_bucket"], list(cols), "column_name", "missing_rate")


def distinct_rows(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``unique(df[, cols])``."""
    return df.select(*cols).distinct()


def accuracy(df: DataFrame, label_col: str, pred_col: str) -> DataFrame:
    """Diagonal over total of the confusion table."""
    return df.agg(F.avg((F.col(label_col) == F.col(pred_col)).cast("double")).alias("accuracy"),
                  F.avg((F.col(label_col) != F.col(pred_col)).cast("double")).alias("misclass"))


# ------------------------------------------------------------------ A15-A18

def pearson_long(df: DataFrame, cols: Sequence[str], use: str = "everything") -> DataFrame:
    """Pearson matrix in long form ``(var1, var2, corr)``.

    ``use="everything"`` keeps R's rule: a column with any null gives NA.
    ``use="pairwise"`` uses the pairs where both values are present.
    All p(p+1)/2 ``corr`` aggregates run in one pass (a stable co-moment
    update in the JVM).
    """
    cols = list(cols)
    aggs = []
    for i, a in enumerate(cols):
        for b in cols[i:]:
            aggs.append(F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"{i}__{cols.index(b)}"))
    if use == "everything":
        aggs += [F.count_if(F.col(c).isNull()).alias(f"{c}__nulls") for c in cols]
    one = df.agg(*aggs)
    structs = []
    for i, a in enumerate(cols):
        for j, b in enumerate(cols):
            lo, hi = min(i, j), max(i, j)
            v = F.col(f"{lo}__{hi}")
            if i == j:
                v = F.when(v.isNotNull(), F.lit(1.0))
            if use == "everything":
                v = F.when((F.col(f"{a}__nulls") == 0) & (F.col(f"{b}__nulls") == 0), v)
            structs.append(F.struct(F.lit(a).alias("var1"), F.lit(b).alias("var2"),
                                    v.cast("double").alias("corr")))
    return _explode_single_row(one, structs)


def rank_table(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Mid-rank (``rank(x)``, ties averaged) of every distinct value, per column.

    ``(column_name, value, rank)`` from value counts and distributed running
    sums -- no window over a whole column.
    """
    long = melt(df, cols, "double").filter(F.col("value").isNotNull())
    counts = long.groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("_n"))
    cum = running_sums(counts, ["value"], ["_n"], group_cols=["column_name"])
    return cum.select("column_name", "value",
                      (F.col("cum__n") - (F.col("_n") - 1) / 2.0).alias("rank"))


def mid_ranks(df: DataFrame, cols: Sequence[str], key_cols: Sequence[str]) -> DataFrame:
    """Row-level mid-ranks in long form ``(key..., column_name, value, rank)``."""
    long = melt(df, cols, "double", id_cols=key_cols).filter(F.col("value").isNotNull())
    return long.join(rank_table(df, cols), ["column_name", "value"])


def with_rank_columns(df: DataFrame, cols: Sequence[str], prefix: str = "r_") -> DataFrame:
    """Add one mid-rank column per column by joining each column's value->rank
    table on the value (small tables are broadcast by AQE); the wide frame is
    never melted or pivoted."""
    ranks = rank_table(df, cols).persist()
    out = df
    for c in cols:
        t = ranks.filter(F.col("column_name") == c).select(
            F.col("value").alias("_rv"), F.col("rank").alias(prefix + c))
        out = out.join(t, F.col(c).cast("double") == F.col("_rv"), "left").drop("_rv")
    return out


def spearman_long(df: DataFrame, cols: Sequence[str], key_cols: Sequence[str] = ()) -> DataFrame:
    """Spearman correlations with n, t and two-sided p (``corr.test``).

    Pairwise-complete: a value is ranked among the rows where its partner is
    present too.  Partners with the same role need the same ranks, so a column
    has one rank for itself and one per other column with nulls; all of them
    come from one melted count and one running sum, and all pairs from one
    aggregate.  The number of jobs does not depend on the number of pairs.
    """
    cols = list(cols)
    holes = {r["column_name"] for r in missing_profile(df, cols).collect() if r["n_null"]}

    def given(a, b):
        """``a`` where ``b`` is present."""
        return (a, b) if b in holes else (a, None)
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]]
    wanted = sorted({v for a, b in pairs for v in (given(a, b), given(b, a))}, key=str)
    name = {v: f"v{k}" for k, v in enumerate(wanted)}
    views = df.select(*(
        (F.col(a) if m is None else F.when(F.col(m).isNotNull(), F.col(a))).cast("double").alias(name[a, m]) for a, m in wanted))
    rows = []
    if pairs:
        found = _pair_corr_rows(with_rank_columns(views, list(name.values())),
                                [(name[given(a, b)], name[given(b, a)]) for a, b in pairs], prefix="r_")
        rows = [(a, b, r, n) for (a, b), (_, _, r, n) in zip(pairs, found)]
    out = []
    for a, b, r, n in rows:
        df_ = n - 2
        if r is None or df_ <= 0 or abs(r) >= 1:
            t = math.inf if (r is not None and abs(r) >= 1) else None
            p = 0.0 if t is not None else None
        else:
            t = r * math.sqrt(df_ / (1 - r * r))
            p = t_sf_two_sided(t, df_)
        out.append((a, b, r, int(n), t, p))
        out.append((b, a, r, int(n), t, p))
    schema = "var1 string, var2 string, rho double, n long, t double, p_value double"
    # p(p-1) rows of pair statistics: bounded by the column count
    return df.sparkSession.createDataFrame(out, schema)


def _pair_corr_rows(wide: DataFrame, pairs, prefix: str = ""):
    aggs = []
    for k, (a, b) in enumerate(pairs):
        ra, rb = F.col(prefix + a), F.col(prefix + b)
        aggs.append(F.corr(ra, rb).alias(f"r{k}"))
        aggs.append(F.count(F.when(ra.isNotNull() & rb.isNotNull(), 1)).alias(f"n{k}"))
    if not aggs:
        return []
    row = wide.agg(*aggs).collect()[0]
    return [(a, b, row[f"r{k}"], row[f"n{k}"]) for k, (a, b) in enumerate(pairs)]


def abs_corr_summary(corr: DataFrame) -> DataFrame:
    """Per variable, sum and max of |corr| over its column (diagonal included)."""
    return corr.groupBy("var1").agg(F.sum(F.abs("corr")).alias("sum_abs"),
                                    F.max(F.abs("corr")).alias("max_abs")) \
               .withColumnRenamed("var1", "column_name")


def histogram(df: DataFrame, cols: Sequence[str], n_bins: int | None = None) -> DataFrame:
    """Equal-width histogram per column, ``(column_name, bin, lo, hi, n)``.

    Bin count defaults to Sturges (ceil(log2 n) + 1) as R's ``hist`` does.
    """
    cols = list(cols)
    long = melt(df, cols, "double").filter(F.col("value").isNotNull())
    rng = long.groupBy("column_name").agg(F.min("value").alias("lo"), F.max("value").alias("hi"),
                                          F.count(F.lit(1)).alias("_n"))
    if n_bins is None:
        nb = F.ceil(F.log2(F.col("_n"))).cast("int") + 1
    else:
        nb = F.lit(int(n_bins))
    rng = rng.withColumn("_nb", nb)
    width = (F.col("hi") - F.col("lo")) / F.col("_nb")
    b = F.when(F.col("hi") == F.col("lo"), F.lit(0)).otherwise(
        F.least(F.floor((F.col("value") - F.col("lo")) / width).cast("int"), F.col("_nb") - 1))
    binned = long.join(F.broadcast(rng), "column_name").withColumn("bin", b)
    return (binned.groupBy("column_name", "bin")
                  .agg(F.count(F.lit(1)).alias("n"),
                       F.first(F.col("lo") + F.col("bin") * width).alias("bin_lo"),
                       F.first(F.col("lo") + (F.col("bin") + 1) * width).alias("bin_hi")))
