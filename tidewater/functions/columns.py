"""Small column helpers shared by the operators (all JVM-side expressions)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"


def as_cols(names: Sequence[str] | str) -> list[str]:
    return [names] if isinstance(names, str) else list(names)


def money(c: Column | str) -> Column:
    """Exact money: DECIMAL(18,2).  Sums over it are order-independent and exact."""
    return (F.col(c) if isinstance(c, str) else c).cast(MONEY)


def net_revenue(price: str = "l_extendedprice", discount: str = "l_discount") -> Column:
    """Price × (1 − discount) computed exactly in decimal."""
    return money(price) * (F.lit(1) - money(discount))


def epoch_seconds(ts: Column | str) -> Column:
    """whole epoch seconds of a TIMESTAMP_NTZ / TIMESTAMP (floor, UTC session).

    NTZ cannot be cast to BIGINT directly; cast to TIMESTAMP first.
    """
    c = F.col(ts) if isinstance(ts, str) else ts
    return c.cast("timestamp").cast("long")
