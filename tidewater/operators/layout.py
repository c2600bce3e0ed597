"""Physical layout operators.

Partition counts are parameters, never constants tuned to one machine; with AQE
on, Spark coalesces small shuffle partitions and splits skewed ones at runtime.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def spread(df: DataFrame, partitions: int, *keys: str) -> DataFrame:
    """L1/L2: hash-repartition (by ``keys`` when given) — a full shuffle; use it only to
    co-locate rows for a following join/window on the same keys or to raise parallelism."""
    return df.repartition(partitions, *keys) if keys else df.repartition(partitions)


def narrow(df: DataFrame, partitions: int) -> DataFrame:
    """L3: fewer partitions without a shuffle (small results only, e.g. before a small write)."""
    return df.coalesce(partitions)


@contextmanager
def persisted(df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK):
    """L4: persist a result reused by several actions; always unpersisted afterwards.
    Memory-and-disk, so an evicted block is re-read from local disk, and a lost
    executor's blocks are recomputed from lineage."""
    df.persist(level)
    try:
        yield df
    finally:
        df.unpersist()


def partition_histogram(df: DataFrame) -> DataFrame:
    """Rows per partition (``spark_partition_id``) — aggregated on the executors."""
    return df.groupBy(F.spark_partition_id().alias("partition_id")).agg(F.count(F.lit(1)).alias("rows"))
