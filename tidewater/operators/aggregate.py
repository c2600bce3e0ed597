"""Aggregations and sort / top-k (§2.7, O1–O7).

Every function returns a lazy DataFrame.  Grouped aggregates are plain
``groupBy().agg()`` so Spark plans a partial (map-side) aggregate before the
shuffle; a hot key therefore costs one pre-aggregated row per map task, not one
row per input row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewater.functions.columns import as_cols


def count_by(df: DataFrame, keys: Sequence[str] | str, name: str = "count") -> DataFrame:
    """Rows per key (``reduceByKey(+)`` / ``countByValue`` kept distributed)."""
    return df.groupBy(*as_cols(keys)).agg(F.count(F.lit(1)).alias(name))


def global_reduce(df: DataFrame, value: str) -> DataFrame:
    """One-row sum / max / min / count / fold(0, +)."""
    v = F.col(value)
    return df.agg(
        F.sum(v).alias("sum_value"),
        F.max(v).alias("max_value"),
        F.min(v).alias("min_value"),
        F.count(v).alias("count_value"),
        F.count(F.lit(1)).alias("count_rows"),
        F.coalesce(F.sum(v), F.lit(0)).alias("fold_value"),
    )


def rows_at_minimum(df: DataFrame, value: str) -> DataFrame:
    """Every row whose ``value`` equals the global minimum (ties kept).

    The minimum is a scalar subquery (one value, computed once), so there is no
    driver round trip in user code, no cross join and no single-task window.
    """
    lo = df.agg(F.min(value)).scalar()
    return df.filter(F.col(value) == lo)


def fill_with_mean(df: DataFrame, column: str, out: str | None = None) -> DataFrame:
    """Replace NULLs by the column mean, kept as DOUBLE (``fillna`` would truncate
    the mean of an integer column).  The mean is a scalar subquery."""
    mean = df.agg(F.avg(F.col(column).cast("double"))).scalar()
    return df.withColumn(out or column, F.coalesce(F.col(column).cast("double"), mean))


def duplicates(df: DataFrame, keys: Sequence[str] | str, name: str = "count") -> DataFrame:
    """Keys that occur more than once (``HAVING count(*) > 1``)."""
    return count_by(df, keys, name).filter(F.col(name) > 1)


def keep_one_per_key(
    df: DataFrame,
    keys: Sequence[str] | str,
    order_by: Sequence[str] | str,
    keep: str = "first",
    near_unique: bool = False,
) -> DataFrame:
    """One deterministic survivor per key (``dropDuplicates`` picks an arbitrary one).

    The survivor is the row with the smallest (``keep='first'``) or largest
    (``keep='last'``) ``order_by`` tuple; include a unique column in ``order_by``
    for a full tie-break.  Implemented as ``min_by``/``max_by`` over a struct so it
    aggregates partially on the map side: a key holding a third of all rows is
    reduced per map task before the shuffle instead of being sorted in one task.

    ``near_unique`` says that few rows share a key, so that nothing can be reduced before the
    shuffle: rows are then shuffled and sorted once, and the first of each key stays,
    where the aggregate would sort whole rows on both sides of the shuffle.
    """
    keys = as_cols(keys)
    order = as_cols(order_by)
    if near_unique:
        by = [F.col(c).asc_nulls_first() if keep == "first" else F.col(c).desc_nulls_last() for c in order]
        first = F.lag(F.lit(1)).over(Window.partitionBy(*keys).orderBy(*by)).isNull()
        return df.withColumn("__first", first).where("__first").drop("__first")
    rest = [c for c in df.columns if c not in keys]
    pick = F.min_by if keep == "first" else F.max_by
    row = F.struct(*[F.col(c) for c in rest])
    ordering = F.struct(*[F.col(c) for c in order])
    return df.groupBy(*keys).agg(pick(row, ordering).alias("__row")).select(*keys, "__row.*")


def pivot_sum(
    df: DataFrame,
    group: Sequence[str] | str,
    pivot_col: str,
    values: Sequence | None,
    measure: Column,
) -> DataFrame:
    """Values of ``pivot_col`` become columns; missing cells are NULL.

    ``values`` None takes every value present, in order, from one distinct job; Spark raises
    beyond ``spark.sql.pivotMaxValues``, so none is dropped.  A list is the caller's own
    choice of columns.
    """
    values = None if values is None else list(values)
    return df.groupBy(*as_cols(group)).pivot(pivot_col, values).agg(measure)


def top_k(df: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    """``orderBy(...).limit(k)`` → ``TakeOrderedAndProject``.

    Each map task keeps only its own k best rows; the final merge sees
    ``k × tasks`` rows, so the cost does not depend on group sizes.  Callers pass a
    unique tie-break as the last ordering column.
    """
    return df.orderBy(*order).limit(k)


def ranked_top_k(df: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    """:func:`top_k` with the place of each row as ``rank`` (from 1), so that the order
    outlives later joins.  The window sees the k rows only."""
    return top_k(df, order, k).withColumn("rank", F.row_number().over(Window.orderBy(*order)))


def calendar_order(month_col: str) -> Column:
    """Sort key for month abbreviations in calendar order (fixed values below)."""
    # English month abbreviations in calendar order.
    months = ["Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec"]
    key = None
    for i, m in enumerate(months, start=1):
        key = (F.when(F.col(month_col) == m, i)) if key is None else key.when(F.col(month_col) == m, i)
    return key.otherwise(13)


def salted_sum_count(
    df: DataFrame,
    key: str,
    value: Column,
    salt_buckets: int = 32,
    salt_from: Sequence[str] | None = None,
) -> DataFrame:
    """J10 (aggregation half): two-phase aggregate for hot keys.

    Phase 1 groups by ``(key, salt)`` so one hot key is spread over
    ``salt_buckets`` reducers; phase 2 folds the partial rows per key.  The salt is
    a hash of row columns (``salt_from``, default all columns), not ``rand()``: a
    recomputed task after executor loss sees the same salt, so retries are exact.
    Sums are over DECIMAL, so the result equals the unsalted aggregate exactly.
    """
    cols = list(salt_from) if salt_from else df.columns
    salted = df.withColumn("__salt", F.pmod(F.xxhash64(*[F.col(c) for c in cols]), F.lit(salt_buckets)))
    part = salted.groupBy(key, "__salt").agg(
        F.count(F.lit(1)).alias("__n"), F.sum(value).alias("__s")
    )
    return part.groupBy(key).agg(F.sum("__n").alias("row_count"), F.sum("__s").alias("total"))
