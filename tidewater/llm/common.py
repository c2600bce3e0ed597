"""Small helpers shared by the training-data operators."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.session import scratch_path

ARROW_ROWS = 256
ARROW_BYTES = 16 << 20
_PACKAGE = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
_shipped: set[str] = set()


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def bounded_batches(spark: SparkSession) -> None:
    """Keep what a Python worker holds at once small, whatever the length of the texts."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES))
    _ship(spark)


def _ship(spark: SparkSession) -> None:
    """Give the executors this package, once for each application: Spark hands out the driver's zip file itself."""
    sc = spark.sparkContext
    if sc.applicationId not in _shipped:
        folder = tempfile.mkdtemp()
        root, name = os.path.split(_PACKAGE)
        sc.addPyFile(shutil.make_archive(os.path.join(folder, f"{name}-package"), "zip", root, name))
        _shipped.add(sc.applicationId)


def run_dir(spark: SparkSession, name: str) -> str:
    """A new folder below the cluster's shared checkpoint folder."""
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex}")


def written(df: DataFrame, folder: str, name: str) -> DataFrame:
    """Write ``df`` as Parquet in a shared folder and read it back: a cut in the lineage that survives lost executors."""
    path = f"{folder}/{name}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def held_out(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 4, is 2.  A null id is never held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def hash_sample(df: DataFrame, key: Column, max_rows: int) -> DataFrame:
    """About ``max_rows`` rows, chosen by a hash of ``key``; all of them where there are no more."""
    n = df.count()
    if n <= max_rows:
        return df
    return df.where(F.pmod(F.xxhash64(key), F.lit(1 << 30)) < int((1 << 30) * max_rows / n))
