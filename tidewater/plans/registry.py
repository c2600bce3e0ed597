"""Query registry: name → (Spark plan builder, equivalent DuckDB SQL or None).

Each plan module calls :func:`register`; ``__spark_entry__`` exposes the result.
Every builder takes ``(spark, sf_dir)`` and returns a lazy DataFrame over the
whole driver tables (no row caps, no id subsets).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Builder = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    build: Builder
    sql: str | None
    ids: tuple[str, ...]  # SURVEY §2 operator IDs covered


_QUERIES: dict[str, Query] = {}


def register(name: str, sql: str | None, ids: str = ""):
    def deco(fn: Builder) -> Builder:
        if name in _QUERIES:
            raise ValueError(f"duplicate query {name}")
        _QUERIES[name] = Query(name, fn, sql, tuple(ids.split()))
        return fn

    return deco


def all_queries() -> dict[str, Query]:
    # Import plan modules for their registration side effect.
    from tidewater.plans import (  # noqa: F401
        commerce,
        relational,
        windows_q,
        text_q,
        cleaning_q,
        quality_q,
        similarity_q,
        streaming_q,
        io_q,
        files_q,
    )

    # Queries whose oracle is another query's SQL (same result by construction).
    for name, same_as in _SHARED_SQL.items():
        q = _QUERIES[name]
        if q.sql is None:
            _QUERIES[name] = Query(q.name, q.build, _QUERIES[same_as].sql, q.ids)
    return dict(_QUERIES)


_SHARED_SQL = {"item_similarity_salted": "item_similarity"}
