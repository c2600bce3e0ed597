"""Intake of raw CSV folders.

One scan tags every row with its file and tells well-formed rows from malformed ones;
one write routes both: ``<out>/is_bad=false`` holds the typed rows, ``<out>/is_bad=true``
the raw lines.  Later reads of either side scan only its folder, and the counts per
file come from the written table, so the raw files are parsed once.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StringType, StructField, StructType

from tidewater.sources import sinks
from tidewater.sources.readers import CORRUPT

FLAG = "is_bad"
FILE, FOLDER = "file_path", "folder"


@dataclass(frozen=True)
class Intake:
    """A routed folder: typed rows, raw malformed lines, and how many of each a file gave."""

    table: DataFrame
    columns: tuple[str, ...]

    @property
    def good(self) -> DataFrame:
        """Well-formed rows with their declared types, and the file they come from."""
        return self.table.where(~F.col(FLAG)).select(*self.columns, FILE, FOLDER)

    @property
    def bad(self) -> DataFrame:
        """Malformed lines as they stand in their file (where a required column is empty: its fields, joined)."""
        return self.table.where(F.col(FLAG)).select(F.col(CORRUPT).alias("line"), FILE, FOLDER)

    def counts(self, *by: str) -> DataFrame:
        """Rows, good and bad, for each file (or each ``by``)."""
        n = lambda c: F.count(F.when(c, 1))
        return self.table.groupBy(*(by or (FILE,))).agg(n(~F.col(FLAG)).alias("n_good"), n(F.col(FLAG)).alias("n_bad"))


def ingest_csv(
    spark: SparkSession,
    path: str,
    schema: StructType | str,
    out: str,
    header: bool = True,
    sep: str = ",",
    encoding: str | None = None,
    required: tuple[str, ...] = (),
    files: int | None = None,
) -> Intake:
    """Read every CSV file at or below ``path`` (a folder or glob), route its rows into ``out``.

    Malformed: too few or too many fields, a value that its declared type does not take, or
    an empty ``required`` column.  Other empty fields are NULL.  With ``header`` the
    first line of every file is skipped.  Overwriting makes a replay leave the same folder.
    ``files`` bounds the part files of each side (None: as many as the scan has tasks).
    """
    st = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
    read = spark.read.option("header", header).option("sep", sep).option("mode", "PERMISSIVE")
    # the header only names the columns of a file; a file that names others is still read by position
    read = read.option("enforceSchema", True).option("recursiveFileLookup", True)
    read = read.option("columnNameOfCorruptRecord", CORRUPT)
    if encoding:
        read = read.option("encoding", encoding)
    rows = read.schema(StructType([*st.fields, StructField(CORRUPT, StringType())])).csv(path)
    lacking = F.lit(False)
    for c in required:
        lacking = lacking | F.col(c).isNull()
    line = F.coalesce(F.col(CORRUPT), F.when(lacking, F.array_join(F.array(*[F.col(c).cast("string") for c in st.names]), sep, "")))
    rows = rows.select(
        *st.names, line.alias(CORRUPT), F.col("_metadata.file_path").alias(FILE),
        F.substring_index(F.substring_index("_metadata.file_path", "/", -2), "/", 1).alias(FOLDER), line.isNotNull().alias(FLAG),
    )
    sinks.write_parquet(rows, out, partition_by=[FLAG], files=files, compression="zstd")
    full = StructType([*st.fields, *(StructField(c, StringType()) for c in (CORRUPT, FILE, FOLDER)), StructField(FLAG, BooleanType())])
    return Intake(spark.read.schema(full).parquet(out), tuple(st.names))
