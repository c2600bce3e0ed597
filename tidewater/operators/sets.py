"""Set operations with the reference's duplicate rules.

For ``[1,1,2,4,4] − [4,2]`` the RDD ``subtract`` keeps ``[1,1]``: every copy of
a matched value goes, unmatched copies stay.  That is a null-safe left anti join,
not ``exceptAll`` (``[1,1,4]``) nor DataFrame ``subtract`` (``[1]``).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame


def _null_safe_on(left: DataFrame, right: DataFrame):
    conds = [left[c].eqNullSafe(right[c]) for c in left.columns]
    return reduce(lambda a, b: a & b, conds)


def union_all(a: DataFrame, b: DataFrame) -> DataFrame:
    """All rows of both, duplicates kept (``UNION ALL``), matched by column name."""
    return a.unionByName(b)


def intersection(a: DataFrame, b: DataFrame) -> DataFrame:
    """Distinct rows present in both (NULLs compare equal, like the RDD version)."""
    return a.intersect(b)


def subtract_all_copies(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows of ``a`` whose value does not occur in ``b``; duplicates of ``a`` kept.

    ``b`` is reduced to distinct values first so the anti join's build side is
    as small as possible.
    """
    bd = b.distinct()
    return a.join(bd, _null_safe_on(a, bd), "left_anti")


def symmetric_difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """``union(a, b) − intersection(a, b)``: rows on exactly one side, copies kept."""
    return subtract_all_copies(a, b).unionByName(subtract_all_copies(b, a))
