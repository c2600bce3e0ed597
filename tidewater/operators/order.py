"""Global order: every row's place in a sorted result, without a window over one partition."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.session import scratch_path

_AT = "_row_at"
_PLACES = 33  # bits of monotonically_increasing_id that hold a row's place in its partition


def global_rank(df: DataFrame, *order: Column | str, name: str = "rank", partitions: int | None = None) -> DataFrame:
    """Adds each row's place (1, 2, 3...) in ``order``.

    Rows go to ranges of the order and are sorted there; the sorted table is written to the shared folder
    with each row's place in its range.  The rows counted in each range (a number for each partition) give
    the places that the ranges begin at.  An order of many equal values must end in columns that tell
    them apart, or they all go to one range; rows that are equal in it get places in no stated order.
    """
    spark = df.sparkSession
    n = partitions or max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    path = scratch_path(spark, f"ranked-{uuid.uuid4().hex}")
    df.repartitionByRange(n, *order).sortWithinPartitions(*order).withColumn(_AT, F.monotonically_increasing_id()).write.parquet(path)
    rows = spark.read.schema(T.StructType([*df.schema.fields, T.StructField(_AT, T.LongType())])).parquet(path)
    part = F.shiftright(_AT, _PLACES).cast("int")
    begins, at = [], 0
    for r in rows.groupBy(part.alias("_part")).count().orderBy("_part").collect():  # one row a partition
        begins.append((r["_part"], at))
        at += r["count"]
    table = F.broadcast(spark.createDataFrame(begins, "_part int, _begin long"))
    place = F.col("_begin") + F.col(_AT).bitwiseAND(F.lit((1 << _PLACES) - 1)) + 1
    return rows.withColumn("_part", part).join(table, "_part").select(*df.columns, place.alias(name))
