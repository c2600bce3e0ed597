"""Sinks, actions and DDL.

Writes are idempotent (``overwrite`` by default), so a re-run after a lost
executor or a failed job leaves the same output.  Small-file control is a
parameter (``files``), never a hard-coded ``coalesce(1)`` on large data.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewater.operators.order import global_rank
from tidewater.session import shuffles_dropped


def write_parquet(
    df: DataFrame,
    path: str,
    mode: str = "overwrite",
    partition_by: Sequence[str] | None = None,
    files: int | None = None,
    compression: str | None = None,
) -> None:
    """K1/K2/K6: Parquet output, optionally partitioned by columns (read-back gets
    partition pruning) and/or narrowed to ``files`` output files without a shuffle.
    The shuffle files of the write go with its end."""
    out = df.coalesce(files) if files else df
    w = out.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if compression:
        w = w.option("compression", compression)
    with shuffles_dropped(df.sparkSession):
        w.parquet(path)


def write_text(df: DataFrame, path: str, mode: str = "overwrite", files: int | None = None) -> None:
    """K5/K6: one line per row; non-string rows are rendered as JSON."""
    if len(df.columns) != 1 or dict(df.dtypes)[df.columns[0]] != "string":
        df = df.select(F.to_json(F.struct(*df.columns)).alias("value"))
    (df.coalesce(files) if files else df).write.mode(mode).text(path)


def create_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    """K4: ``CREATE DATABASE IF NOT EXISTS``."""
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}{loc}")


def save_table(df: DataFrame, name: str, fmt: str = "parquet", v2_catalog: bool = False) -> None:
    """K3/K8: create-or-replace a catalog table.

    On a V2 catalog (Iceberg/Delta installed) ``writeTo(...).createOrReplace()``
    swaps the table atomically; the session catalog rejects REPLACE TABLE AS
    SELECT, so there the table is written with ``saveAsTable(mode='overwrite')``.
    """
    if v2_catalog:
        df.writeTo(name).using(fmt).createOrReplace()
    else:
        df.write.mode("overwrite").format(fmt).saveAsTable(name)


def drop_table(spark: SparkSession, name: str) -> None:
    """K9: ``DROP TABLE IF EXISTS``."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def register_view(df: DataFrame, name: str | None = None) -> str:
    """K7: temp view for SQL text, under a name of its own unless one is given."""
    name = name or f"view_{uuid.uuid4().hex}"
    df.createOrReplaceTempView(name)
    return name


def describe(spark: SparkSession, table: str, comment: str, columns: dict[str, str] | None = None) -> None:
    """Table and column descriptions in the catalog."""
    spark.sql(f"COMMENT ON TABLE {table} IS '{comment.replace(chr(39), chr(39) * 2)}'")
    for col, text in (columns or {}).items():
        spark.sql(f"ALTER TABLE {table} ALTER COLUMN {col} COMMENT '{text.replace(chr(39), chr(39) * 2)}'")


def descriptions(spark: SparkSession, table: str) -> DataFrame:
    """What :func:`describe` wrote, read back: (column, data_type, comment); column NULL is the table itself."""
    rows = [(c.name, c.dataType, c.description) for c in spark.catalog.listColumns(table)]
    rows.append((None, None, spark.catalog.getTable(table).description))
    return spark.createDataFrame(rows, "column string, data_type string, comment string")


def to_driver(df: DataFrame, max_rows: int = 100_000) -> list:
    """The rows as a list on the driver; more than ``max_rows`` is an error, not a silent cut."""
    rows = df.limit(max_rows + 1).collect()
    if len(rows) > max_rows:
        raise ValueError(f"more than {max_rows} rows: write them to a table instead")
    return rows


def create_keyed_table(spark: SparkSession, name: str, columns: str, key: str, fmt: str = "parquet") -> None:
    """A table with a generated key; every insert is a partition of its own."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({key} BIGINT, {columns}, load_id STRING) USING {fmt} PARTITIONED BY (load_id)")


def insert_with_key(df: DataFrame, name: str, key: str, order_by: Sequence[str], load_id: str) -> None:
    """Insert rows whose keys go on, without gaps, from the table's largest.

    Rows are numbered in ``order_by`` order through range partitions.  The insert overwrites the
    partition of its ``load_id`` alone: a load that failed half-way or is run again gets
    the keys it had.  A load that others already follow must come with as many rows
    as before, or its keys would meet theirs; that is an error.  One load at a time.
    """
    spark = df.sparkSession
    table = spark.table(name)
    own = table.where(F.col("load_id") == load_id).agg(F.min(key).alias("low"), F.count(F.lit(1)).alias("n")).first()
    top = table.where(F.col("load_id") != load_id).agg(F.max(key).alias("high")).first().high or 0
    base = own.low - 1 if own.n else top
    columns = [c for c in table.columns if c not in (key, "load_id")]
    ranked = global_rank(df.select(*columns), *order_by, name=key)
    rows = ranked.select((F.col(key) + base).alias(key), *columns)
    if top > base and rows.count() != own.n:
        raise ValueError(f"load {load_id!r} is followed by others and had {own.n} rows")
    view = f"load_{uuid.uuid4().hex}"
    rows.createOrReplaceTempView(view)
    try:
        text = load_id.replace("\\", "\\\\").replace("'", "\\'")
        spark.sql(f"INSERT OVERWRITE TABLE {name} PARTITION (load_id = '{text}') SELECT * FROM {view}")
    finally:
        spark.catalog.dropTempView(view)


def with_dense_key(df: DataFrame, order_by: Sequence[str], key: str = "id", partitions: int | None = None) -> DataFrame:
    """Dense surrogate key 1..n in ``order_by`` order without a single-partition window.

    Rows are range-partitioned on ``order_by`` and checkpointed (reliable, in the
    shared checkpoint folder) so the layout is fixed; each row gets its rank inside
    its partition; the per-partition counts (one row per partition — a bound set by
    the partition count) are prefix-summed and broadcast back as offsets.
    ``order_by`` must be unique for the numbering to be deterministic.
    """
    n = partitions or df.sparkSession.sparkContext.defaultParallelism
    ranged = df.repartitionByRange(n, *order_by).withColumn("__pid", F.spark_partition_id()).checkpoint(eager=True)
    local = ranged.withColumn(
        "__local", F.row_number().over(Window.partitionBy("__pid").orderBy(*order_by))
    )
    counts = ranged.groupBy("__pid").agg(F.count(F.lit(1)).alias("__n"))
    offsets = counts.withColumn(
        "__offset",
        F.coalesce(F.sum("__n").over(Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
    ).select("__pid", "__offset")
    return (
        local.join(F.broadcast(offsets), "__pid")
        .withColumn(key, (F.col("__offset") + F.col("__local")).cast("long"))
        .drop("__pid", "__local", "__offset")
    )
