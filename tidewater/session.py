"""Session construction and the shared checkpoint folder.

On a cluster the session is created by the launcher and already carries
``spark.checkpoint.dir`` (a shared, fault-tolerant folder).  We only read it.
A private folder is chosen solely when the setting is missing, which is the
case for local tests and the bench.
"""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"
SHUFFLE_CLEANUP_CONF = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

# Settings every job relies on: AQE for runtime coalescing / skew splits, UTC so
# TIMESTAMP_NTZ columns and the SQL oracle agree, no UI server.
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(
    master: str = "local[8]",
    shuffle_partitions: int = 8,
    app_name: str = "tidewater",
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or fetch) a session with the library's defaults."""
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(BASE_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", "16g")
    if extra:
        conf.update(extra)
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, creating a private one only if unset.

    The folder is also registered with the SparkContext so ``DataFrame.checkpoint``
    (reliable, not local) writes there.
    """
    path = spark.conf.get(CHECKPOINT_CONF, None)
    if not path:
        master = spark.conf.get("spark.master", "")
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError(f"{CHECKPOINT_CONF} must name a folder that all executors of {master!r} share")
        path = tempfile.mkdtemp(prefix="tidewater-ckpt-")
        spark.conf.set(CHECKPOINT_CONF, path)
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: the server side owns the checkpoint setting
        return path
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(path)
    return path


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Writes begun inside leave no shuffle files: they go when the write ends, not when the driver happens to collect garbage."""
    before = spark.conf.get(SHUFFLE_CLEANUP_CONF, None)
    spark.conf.set(SHUFFLE_CLEANUP_CONF, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP_CONF)
        else:
            spark.conf.set(SHUFFLE_CLEANUP_CONF, before)


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` in the shared checkpoint folder, without the shuffle files that led there."""
    ensure_checkpoint_dir(df.sparkSession)
    with shuffles_dropped(df.sparkSession):
        return df.select("*").checkpoint(eager=True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint folder for written intermediate tables."""
    root = ensure_checkpoint_dir(spark)
    return os.path.join(root, name)
