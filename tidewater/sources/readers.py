"""File sources.

All readers take an explicit schema by default (no inference pass), accept any
path string the cluster's file systems understand (local, HDFS, object stores —
the connector is a deployment matter), and return lazy DataFrames so Catalyst
prunes columns and pushes filters into the scan.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

CORRUPT = "_corrupt_record"


def read_text(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """One ``value`` row per line (also the DataFrame form of ``sc.textFile``)."""
    return spark.read.text(path)


def read_csv(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: StructType | str | None = None,
    header: bool = True,
    sep: str = ",",
    infer_schema: bool = False,
    encoding: str | None = None,
    mode: str = "PERMISSIVE",
    keep_corrupt: bool = False,
    with_file_name: bool = False,
) -> DataFrame:
    """Delimited files; a glob or folder reads many files, each with its header.

    * ``schema`` (StructType or DDL) is applied with ``.schema()``; passing it as an
      option would be ignored by Spark and every column would stay text (the
      reference's schema trap).
    * ``infer_schema`` costs an extra pass and is off unless asked for.
    * ``keep_corrupt`` adds ``_corrupt_record`` (malformed lines keep their raw text);
      ``with_file_name`` adds ``file_path`` and ``file_name`` from the hidden ``_metadata``.
    """
    r = spark.read.option("header", header).option("sep", sep).option("mode", mode)
    if encoding:
        r = r.option("encoding", encoding)
    if schema is not None:
        st = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
        if keep_corrupt and CORRUPT not in st.fieldNames():
            st = StructType(st.fields + [StructField(CORRUPT, StringType(), True)])
            r = r.option("columnNameOfCorruptRecord", CORRUPT)
        r = r.schema(st)
    elif infer_schema:
        r = r.option("inferSchema", True)
    df = r.csv(path)
    if with_file_name:
        df = df.withColumns({"file_path": F.col("_metadata.file_path"), "file_name": F.col("_metadata.file_name")})
    return df


def split_malformed(df: DataFrame, corrupt_col: str = CORRUPT) -> tuple[DataFrame, DataFrame]:
    """(good rows without the corrupt column, quarantined rows)."""
    good = df.filter(F.col(corrupt_col).isNull()).drop(corrupt_col)
    bad = df.filter(F.col(corrupt_col).isNotNull())
    return good, bad


def parse_delimited(
    lines: DataFrame, sep: str, fields: Sequence[tuple[str, str]], value: str = "value"
) -> DataFrame:
    """Split text records on a (possibly multi-character) literal separator and
    ``try_cast`` each field (malformed numbers → NULL, never an ANSI error)."""
    import re

    parts = F.split(F.col(value), re.escape(sep))
    return lines.select(*[F.get(parts, i).try_cast(t).alias(n) for i, (n, t) in enumerate(fields)])


def numbers(spark: SparkSession, start: int, end: int, partitions: int | None = None) -> DataFrame:
    """``sc.parallelize(range)`` as a distributed ``range`` (column ``value``)."""
    return spark.range(start, end, 1, partitions).withColumnRenamed("id", "value")


def read_table(spark: SparkSession, name: str, limit: int | None = None) -> DataFrame:
    """A catalog table by name; ``limit`` only for the verification peek."""
    df = spark.table(name)
    return df.limit(limit) if limit is not None else df
