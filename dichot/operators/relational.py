"""Projections, filters, joins, ordering and set operators
(P01-P18, J01-J04, O01-O04, U01-U04).

Most of these are one DataFrame call; they are collected here so the
R-to-Spark mapping is explicit and the few R conventions (1-based positions,
suffixes on clashing merge columns, NA keys in merges) are stated once.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dichot.operators.ordered import row_index, row_slice
from dichot.operators.profile import distinct_profile, missing_profile


# ------------------------------------------------------------------ P01-P03

def select_by_name(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``df[, vars]``."""
    return df.select(*cols)


def select_by_position(df: DataFrame, positions: Sequence[int]) -> DataFrame:
    """``df[, c(2, 3, 5)]`` (1-based) or ``df[, -1]`` (negative drops)."""
    positions = list(positions)
    if all(p < 0 for p in positions):
        drop = {df.columns[-p - 1] for p in positions}
        return df.select(*[c for c in df.columns if c not in drop])
    return df.select(*[df.columns[p - 1] for p in positions])


def drop_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``df[, !names(df) %in% cols]``."""
    return df.drop(*cols)


def drop_blank_columns(df: DataFrame, max_blank: int = 100) -> tuple[DataFrame, list[str]]:
    """Drop text columns with more than ``max_blank`` empty strings."""
    prof = missing_profile(df).filter(F.col("n_blank") > max_blank)
    gone = sorted(r["column_name"] for r in prof.collect())
    return df.drop(*gone), gone


def drop_null_columns(df: DataFrame, max_null: int | None = 500,
                      max_fraction: float | None = None) -> tuple[DataFrame, list[str]]:
    """Drop columns with more than ``max_null`` nulls (or a row fraction)."""
    prof = missing_profile(df)
    if max_fraction is not None:
        n = df.count()
        prof = prof.filter(F.col("n_null") > max_fraction * n)
    else:
        prof = prof.filter(F.col("n_null") > max_null)
    gone = sorted(r["column_name"] for r in prof.collect())
    return df.drop(*gone), gone


def drop_high_cardinality(df: DataFrame, cols: Sequence[str], max_distinct: int) -> tuple[DataFrame, list[str]]:
    """Drop categorical columns with more than ``max_distinct`` values."""
    prof = distinct_profile(df, cols).filter(F.col("n_distinct") > max_distinct)
    gone = sorted(r["column_name"] for r in prof.collect())
    return df.drop(*gone), gone


# ------------------------------------------------------------------ P07-P18

def not_null(df: DataFrame, col: str) -> DataFrame:
    """``df[!is.na(df$x), ]`` (the ``-which()`` form is not copied: see D5)."""
    return df.filter(F.col(col).isNotNull())


def complete_cases(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """``na.omit(df)``."""
    return df.dropna(how="any", subset=list(cols) if cols else None)


def filter_equal(df: DataFrame, col: str, value) -> DataFrame:
    """``df[which(df$State == "DC"), ]``; NA never matches."""
    return df.filter(F.col(col) == F.lit(value))


def filter_in(df: DataFrame, col: str, values: Sequence, negate: bool = False) -> DataFrame:
    """P10 for literal lists: ``x %in% y`` / ``!x %in% y``."""
    cond = F.col(col).isin(list(values))
    return df.filter(~cond if negate else cond)


def if_else(cond: Column, yes, no) -> Column:
    """``ifelse(cond, yes, no)``; NA condition gives NA like R."""
    return F.when(cond.isNull(), F.lit(None)).when(cond, yes).otherwise(no)


def threshold_class(prob: Column, threshold: float = 0.5, yes=1.0, no=0.0) -> Column:
    """Class from probability with a strict ``>``; a null or NaN
    probability gives no class, as R's ``ifelse`` does."""
    known = prob.isNotNull() & ~F.isnan(prob.cast("double"))
    return F.when(known & (prob > F.lit(threshold)), F.lit(yes)).when(known, F.lit(no))


def head(df: DataFrame, order_cols: Sequence[str], n: int = 6) -> DataFrame:
    """``head(df, n)`` over a stated key order (TakeOrdered)."""
    return df.orderBy(*order_cols).limit(n)


def slice_rows(df: DataFrame, order_cols: Sequence[str], start: int, stop: int) -> DataFrame:
    """``data[start:stop, ]`` along a key order."""
    return row_slice(df, order_cols, start, stop)


def reindex(df: DataFrame, order_cols: Sequence[str], name: str = "row_idx") -> DataFrame:
    """``rownames(df) <- NULL``: a dense 1..n index in key order."""
    return row_index(df, order_cols, name=name)


def column_bind(left: DataFrame, right: DataFrame, key: Sequence[str]) -> DataFrame:
    """``cbind(a, b)`` done safely: columns of two frames put side by side by
    joining on the row key, never by position."""
    return left.join(right, list(key), "inner")


def nonzero(df: DataFrame, col: str) -> DataFrame:
    """``results[results$Weight != 0, ]``."""
    return df.filter(F.col(col) != 0)


# ------------------------------------------------------------------ joins

#: rows of one key beyond which ``merge`` splits it
HOT_KEY_ROWS = 1_000_000
#: rows of a many-to-many merge that one part of a key makes
PART_ROWS = 4_000_000
#: bytes of the right side of a many-to-many merge that every executor holds at most; beyond it its rows are repeated for each part
BROADCAST_BYTES = 32 << 20
#: hot keys that are broadcast at most; beyond it their join shuffles
BROADCAST_HOT_KEYS = 1 << 17


def _same_key(by: Sequence[str], null_safe: bool, a: str = "_x", b: str = "_y"):
    cond = F.lit(True)
    for k in by:
        x, y = F.col(f"{a}.`{k}`"), F.col(f"{b}.`{k}`")
        cond = cond & (x.eqNullSafe(y) if null_safe else x == y)
    return cond


def merge(x: DataFrame, y: DataFrame, by: Sequence[str], suffixes=(".x", ".y"),
          null_safe: bool = False, how: str = "inner", hot_rows: int | None = None,
          part_rows: int | None = None) -> DataFrame:
    """``merge(x, y, by=...)``: equi-join, clashing non-key columns suffixed.

    The strategy (broadcast hash or sort-merge) is left to Catalyst and AQE,
    which decide from the measured size of each side.  ``null_safe`` matches
    NA keys to NA keys as R's merge does.

    With ``hot_rows`` (``inner`` and ``left`` only) the keys, composite or NA
    too, are counted in ``x`` first.  A key with more rows is dealt by a hash of
    the row into parts of about that many, and the rows of ``y`` with this key are
    repeated for each part, so no task holds a whole hot key.  ``y`` should hold
    few rows a key, as a lookup table does.

    With ``part_rows`` instead, for many-to-many merges (``inner`` and ``left``),
    the rows that each key makes are counted from both sides first, and there are
    as many tasks as parts of about that many: a small input with few keys
    neither leaves all its output to one task, nor lets AQE join it in one.
    If ``y`` has at most ``BROADCAST_BYTES``, as counted, every executor holds it
    and the rows of ``x`` are dealt evenly, so that what is shuffled is ``x`` once.
    Otherwise a key that makes more rows is dealt into parts as above; what is
    repeated for them grows faster than the input.
    """
    by = list(by)
    clash = (set(x.columns) & set(y.columns)) - set(by)
    xs = x.select(*[F.col(f"`{c}`").alias(c + suffixes[0]) if c in clash else F.col(f"`{c}`") for c in x.columns])
    ys = y.select(*[F.col(f"`{c}`").alias(c + suffixes[1]) if c in clash else F.col(f"`{c}`") for c in y.columns])
    on = list(by)
    if hot_rows is not None:
        if how not in ("inner", "left") or hot_rows < 1:
            raise ValueError("hot keys are split in inner and left merges, into parts of one row or more")
        xs, ys, salt = _salted(xs, ys, by, hot_rows)
        on.append(salt)
    elif part_rows is not None:
        if how not in ("inner", "left") or part_rows < 1:
            raise ValueError("keys are dealt in inner and left merges, into parts of one row or more")
        xs, ys, salt = _dealt(xs, ys, by, part_rows, null_safe)
        on += [salt] if salt else []
    if not null_safe:
        out = xs.join(ys, on, how)
        return out.drop(salt) if len(on) > len(by) else out
    cond = _same_key(on, True)
    cols = [F.col(f"_x.`{c}`") for c in (*by, *(c for c in xs.columns if c not in on))]
    cols += [F.col(f"_y.`{c}`") for c in ys.columns if c not in on]
    return xs.alias("_x").join(ys.alias("_y"), cond, how).select(*cols)


def _salted(xs: DataFrame, ys: DataFrame, by: Sequence[str], hot_rows: int) -> tuple[DataFrame, DataFrame, str]:
    """Both sides with a salt column: parts of hot keys in ``xs``, one copy of a
    row of ``ys`` for every part of its key."""
    salt = "_salt"
    while salt in xs.columns or salt in ys.columns:
        salt += "_"
    # a key has more than hot_rows rows, so there are at most rows / hot_rows of them
    hot = xs.groupBy(*(F.col(f"`{k}`") for k in by)).agg(F.count(F.lit(1)).alias(salt)).where(F.col(salt) > hot_rows)
    hot = hot.withColumn(salt, F.ceil(F.col(salt) / F.lit(hot_rows)).cast("long"))
    dealt, copies = _in_parts(xs, ys, by, hot, hot.count(), salt)
    return dealt, copies, salt


def _in_parts(xs: DataFrame, ys: DataFrame, by: Sequence[str], hot: DataFrame, keys: int, salt: str) -> tuple[DataFrame, DataFrame]:
    """``xs`` dealt by a hash of the row into the parts that ``hot`` gives its key, ``ys`` repeated for each part."""
    if keys <= BROADCAST_HOT_KEYS:
        hot = F.broadcast(hot)

    def parts(side):
        met = side.alias("_s").join(hot.alias("_h"), _same_key(by, True, "_s", "_h"), "left")
        return met, F.coalesce(F.col(f"_h.{salt}"), F.lit(1).cast("long")), [F.col(f"_s.`{c}`") for c in side.columns]
    met, n, cols = parts(xs)
    dealt = met.select(*cols, F.pmod(F.xxhash64(*cols), n).alias(salt))
    met, n, cols = parts(ys)
    copies = met.select(*cols, F.explode(F.sequence(F.lit(0).cast("long"), n - 1)).alias(salt))
    return dealt, copies


def _dealt(xs: DataFrame, ys: DataFrame, by: Sequence[str], part_rows: int, null_safe: bool) -> tuple[DataFrame, DataFrame, str | None]:
    """Both sides over a task for each ``part_rows`` rows of the merge: ``xs`` dealt
    evenly beside a broadcast ``ys``, or both dealt by key and a salt column."""
    salt = "_salt"
    while salt in xs.columns or salt in ys.columns:
        salt += "_"
    mine, theirs = (side.groupBy(*(F.col(f"`{k}`") for k in by)).agg(F.count(F.lit(1)).alias(salt)) for side in (xs, ys))
    made = F.col(f"_x.{salt}").cast("double") * F.col(f"_y.{salt}")
    # no more parts than rows of xs to deal
    parts = F.least(F.ceil(made / F.lit(part_rows)), F.col(f"_x.{salt}")).cast("long")
    hot = (mine.alias("_x").join(theirs.alias("_y"), _same_key(by, null_safe))
           .select(*(F.col(f"_x.`{k}`").alias(k) for k in by), parts.alias(salt), made.alias("_made")))
    # a number of tasks for all rows of the merge, also those of keys too small to be dealt
    rows, keys = hot.agg(F.sum("_made"), F.sum((F.col(salt) > 1).cast("long"))).first()
    tasks = max(xs.sparkSession.sparkContext.defaultParallelism, math.ceil((rows or 0) / part_rows))
    if _bytes(ys, BROADCAST_BYTES) <= BROADCAST_BYTES:
        return xs.repartition(tasks), F.broadcast(ys), None
    dealt, copies = _in_parts(xs, ys, by, hot.where(F.col(salt) > 1).drop("_made"), keys or 0, salt)
    on = [F.col(f"`{c}`") for c in (*by, salt)]
    return dealt.repartition(tasks, *on), copies.repartition(tasks, *on), salt


def _bytes(df: DataFrame, enough: int) -> int:
    """What the rows of ``df`` hold, 16 bytes a row beside them; more than
    ``enough`` where a column has no known width."""
    width, cells = F.lit(16), []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            cells.append(F.coalesce(F.octet_length(F.col(f"`{f.name}`")), F.lit(0)) + 16)
        elif isinstance(f.dataType, (T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)):
            cells.append(F.lit(16))
        else:
            return enough + 1
    return df.agg(F.sum(sum(cells, width).cast("long"))).first()[0] or 0


def semi(df: DataFrame, keys: DataFrame, on: Sequence[str]) -> DataFrame:
    """J04/P10 with a table: rows whose key is in ``keys``."""
    return df.join(keys.select(*on), list(on), "left_semi")


def anti(df: DataFrame, keys: DataFrame, on: Sequence[str]) -> DataFrame:
    """``df[-Train, ]``: rows whose key is not in ``keys``."""
    return df.join(keys.select(*on), list(on), "left_anti")


def expand_grid(*frames: DataFrame, max_rows: int = 100_000) -> DataFrame:
    """``expand.grid`` of small value lists (tuning or prediction grids).

    Every list but the first is broadcast, so each is counted first; one of more
    than ``max_rows`` rows is an error.
    """
    out = frames[0]
    for f in frames[1:]:
        if f.limit(max_rows + 1).count() > max_rows:
            raise ValueError(f"a list of the grid has more than {max_rows} rows")
        out = out.crossJoin(F.broadcast(f))
    return out


# ------------------------------------------------------------------ order

def sort_desc(df: DataFrame, col: str, *tie_cols: str) -> DataFrame:
    """``df[order(x, decreasing=TRUE), ]``."""
    return df.orderBy(F.col(col).desc(), *tie_cols)


def sort_asc(df: DataFrame, col: str, *tie_cols: str) -> DataFrame:
    """O02."""
    return df.orderBy(F.col(col).asc(), *tie_cols)


def top_k(df: DataFrame, col: str, k: int, tie_cols: Sequence[str] = ()) -> DataFrame:
    """The k largest rows (TakeOrderedAndProject, no full sort)."""
    return df.orderBy(F.col(col).desc(), *tie_cols).limit(k)


def above(df: DataFrame, col: str, threshold: float) -> DataFrame:
    """Importance above a threshold (``> 2 varImp``)."""
    return df.filter(F.col(col) > threshold)


# ------------------------------------------------------------------ sets

def intersect(*frames: DataFrame) -> DataFrame:
    """``intersect(a, b)`` (nested for three or more)."""
    out = frames[0]
    for f in frames[1:]:
        out = out.intersect(f)
    return out


def union_distinct(*frames: DataFrame) -> DataFrame:
    """``unique(c(a, b))``."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out.distinct()


def union_all(*frames: DataFrame) -> DataFrame:
    """Row sets stacked, duplicates kept."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def except_(a: DataFrame, b: DataFrame, keep_duplicates: bool = True) -> DataFrame:
    """``a[!a %in% b]``: every row of ``a`` whose value is absent from ``b``.

    Duplicates in ``a`` are kept (a null-safe left anti join); with
    ``keep_duplicates=False`` it is SQL ``EXCEPT``.
    """
    if not keep_duplicates:
        return a.subtract(b)
    xa, yb = a.alias("_a"), b.alias("_b")
    cond = None
    for c in a.columns:
        t = F.col(f"_a.{c}").eqNullSafe(F.col(f"_b.{c}"))
        cond = t if cond is None else cond & t
    return xa.join(yb, cond, "left_anti")
