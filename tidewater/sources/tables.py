"""Driver tables (S15: declared raw sources by name → path)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLE_NAMES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

# Tables this small are never worth a shuffle to spread (dimension tables).
_SPREAD_MIN_ROWS_HINT = {"region", "nation", "supplier", "benchmark", "labels"}


_NARROW: dict[tuple[str, int], bool] = {}


def spread_if_narrow(df: DataFrame, key: str | None = None) -> DataFrame:
    """Round-robin a scan that yields fewer splits than the cluster can run at once.

    A Parquet file with a single row group is one split, so every row-level
    expression before the first shuffle would run in one task.  On a cluster,
    large inputs have many more splits than cores and this is a no-op; it only
    fires for narrow inputs.  Round-robin repartitioning sorts locally first, so a
    recomputed task after executor loss produces the same rows.

    The split count is remembered per ``key`` (the path): it only steers the layout,
    so a stale entry can cost speed but never change a result.
    """
    try:
        target = df.sparkSession.sparkContext.defaultParallelism
        memo = (key, target) if key else None
        if memo is not None and memo in _NARROW:
            narrow = _NARROW[memo]
        else:
            narrow = df.rdd.getNumPartitions() * 2 <= target
            if memo is not None:
                _NARROW[memo] = narrow
    except Exception:  # e.g. a Spark Connect session: no RDD view, leave the plan alone
        return df
    return df.repartition(target) if narrow else df


def table(spark: SparkSession, sf_dir: str, name: str, spread: bool = False) -> DataFrame:
    """Read one Parquet table; Catalyst prunes columns and pushes filters into the scan.

    ``spread=True`` is for plans with heavy per-row work before their first shuffle
    (regex tokenising, text rendering, hashing whole texts): a narrow scan is then
    spread over the cluster first.  Join- and aggregate-led plans leave it off — their
    first shuffle already parallelises the work, and an extra exchange only costs.
    """
    if name not in TABLE_NAMES:
        raise KeyError(f"unknown table {name!r}")
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    df = spark.read.parquet(path)
    if spread and name not in _SPREAD_MIN_ROWS_HINT:
        df = spread_if_narrow(df, path)
    return df


class Tables:
    """Attribute access to the driver tables of one scale-factor folder."""

    def __init__(self, spark: SparkSession, sf_dir: str, spread: bool = False):
        self.spark = spark
        self.sf_dir = sf_dir
        self.spread = spread

    def __getattr__(self, name: str) -> DataFrame:
        if name in TABLE_NAMES:
            return table(self.spark, self.sf_dir, name, self.spread)
        raise AttributeError(name)

    def register_views(self) -> None:
        """K7: expose every table as a temp view so SQL text can name it."""
        for n in TABLE_NAMES:
            table(self.spark, self.sf_dir, n, self.spread).createOrReplaceTempView(n)
