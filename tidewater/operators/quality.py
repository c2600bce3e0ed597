"""Declarative data tests.

Each test returns the *failing rows* as a DataFrame (empty = pass), like the dbt
tests they come from; :func:`run_tests` folds any such tests into one summary with a
pass for each.  :func:`run_suite` counts the failures of whole models with one scan of each.
Nothing is collected: callers decide whether to count, show or write the failures.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def unique(df: DataFrame, column: str) -> DataFrame:
    """Q1: values of ``column`` occurring more than once (NULLs ignored), with their count."""
    return (
        df.filter(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("n_records"))
        .filter(F.col("n_records") > 1)
    )


def not_null(df: DataFrame, column: str) -> DataFrame:
    """Q2: rows where ``column`` is NULL."""
    return df.filter(F.col(column).isNull())


def accepted_values(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """Q3: rows whose ``column`` is outside ``values``; NULL passes (as in dbt)."""
    return df.filter(F.col(column).isNotNull() & ~F.col(column).isin(list(values)))


def relationships(df: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Q4: rows whose non-NULL ``column`` has no match in ``parent.parent_column``."""
    p = parent.select(F.col(parent_column).alias("__pk")).distinct()
    return df.filter(F.col(column).isNotNull()).join(p, F.col(column) == F.col("__pk"), "left_anti")


@dataclass(frozen=True)
class Check:
    model: str
    column: str
    test: str
    failures: DataFrame


def run_tests(checks: Sequence[Check]) -> DataFrame:
    """Summary table ``(model, column, test, failures, status)``, one row per test.

    Every test is reduced to a one-row count on the executors, and the rows are
    unioned; the driver never sees failing rows.
    """
    rows = [
        c.failures.agg(F.count(F.lit(1)).alias("failures")).select(
            F.lit(c.model).alias("model"), F.lit(c.column).alias("column"), F.lit(c.test).alias("test"), "failures"
        )
        for c in checks
    ]
    out = reduce(DataFrame.unionByName, rows)
    return out.withColumn("status", F.when(F.col("failures") == 0, "pass").otherwise("fail"))


@dataclass(frozen=True)
class Model:
    """A model and its tests: columns that must be unique or not NULL, the values a column may
    take, and (column, parent model, parent column) of foreign keys."""

    name: str
    rows: DataFrame
    unique: Sequence[str] = ()
    not_null: Sequence[str] = ()
    accepted: dict[str, Sequence] = field(default_factory=dict)
    relationships: Sequence[tuple[str, str, str]] = ()


def run_suite(models: Sequence[Model]) -> DataFrame:
    """Summary table ``(model, column, test, failures, status)`` of all tests of all models, each model scanned once.

    A row gives one entry to every key that a test is about, and the row-level failures ride on
    the first.  A unique column and the foreign keys that point at it are one kind of key,
    so entries with equal (kind, key), counted before the shuffle, show at once how
    many parents the key has and how many children: a foreign key is checked without a join, and a
    child that a third of all rows point at is one row a task.  The summary is one aggregate over
    those counts.  Keys are compared as text.  NULL is no duplicate, needs no parent and is an
    accepted value.
    """
    kinds: list[tuple[str, str]] = []
    for m in models:
        for key in [*((m.name, c) for c in m.unique), *((p, c) for _, p, c in m.relationships)]:
            if key not in kinds:
                kinds.append(key)
    by_name = {m.name: m for m in models}
    missing = [p for m in models for _, p, _ in m.relationships if p not in by_name]
    if missing:
        raise ValueError(f"no such parent model: {missing}")
    children = [(m.name, c, (p, pc)) for m in models for c, p, pc in m.relationships]
    checks = [(m.name, c, "not_null") for m in models for c in m.not_null] + [(m.name, c, "accepted_values") for m in models for c in m.accepted]

    entries = []
    for m in models:
        failed = {("not_null", c): F.col(c).isNull() for c in m.not_null}
        failed |= {("accepted_values", c): F.col(c).isNotNull() & ~F.col(c).isin(list(v)) for c, v in m.accepted.items()}
        keys = [(kinds.index(k), F.col(k[1]), "parent", None) for k in kinds if k[0] == m.name]
        keys += [(kinds.index(k), F.col(c), "child", i) for i, (name, c, k) in enumerate(children) if name == m.name]
        keys = keys or [(-1, F.lit(None), "none", None)]
        structs = []
        for place, (kind, key, role, child) in enumerate(keys):
            flags = [F.when(failed[t, c], 1).otherwise(0) if place == 0 and name == m.name else F.lit(0) for name, c, t in checks]
            parts = [F.lit(int(role == "parent")), *(F.lit(int(child == i)) for i in range(len(children))), *flags]
            names = ["parents", *(f"child{i}" for i in range(len(children))), *(f"check{i}" for i in range(len(checks)))]
            structs.append(F.struct(F.lit(kind).alias("kind"), key.cast("string").alias("key"), *(p.cast("long").alias(n) for p, n in zip(parts, names))))
        entries.append(m.rows.select(F.explode(F.array(*structs)).alias("e")).select("e.*"))
    counts = ["parents", *(f"child{i}" for i in range(len(children))), *(f"check{i}" for i in range(len(checks)))]
    per_key = reduce(DataFrame.unionByName, entries).groupBy("kind", "key").agg(*(F.sum(c).alias(c) for c in counts))

    known = F.col("key").isNotNull()
    tests = [(m.name, c, "unique", F.count(F.when((F.col("kind") == kinds.index((m.name, c))) & known & (F.col("parents") > 1), 1))) for m in models for c in m.unique]
    tests += [(*check, F.sum(f"check{i}")) for i, check in enumerate(checks)]
    tests += [
        (name, c, "relationships", F.sum(F.when((F.col("kind") == kinds.index(k)) & known & (F.col("parents") == 0), F.col(f"child{i}"))))
        for i, (name, c, k) in enumerate(children)
    ]
    total = per_key.agg(*(F.coalesce(n, F.lit(0)).alias(f"t{i}") for i, (*_, n) in enumerate(tests)))
    rows = [F.struct(F.lit(m).alias("model"), F.lit(c).alias("column"), F.lit(t).alias("test"), F.col(f"t{i}").alias("failures")) for i, (m, c, t, _) in enumerate(tests)]
    out = total.select(F.explode(F.array(*rows)).alias("r")).select("r.*")
    return out.withColumn("status", F.when(F.col("failures") == 0, "pass").otherwise("fail"))
