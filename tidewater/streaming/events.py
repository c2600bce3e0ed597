"""Event-stream operators on Structured Streaming.

The event contract is a JSON value per event, ``{"event_type": ..., "timestamp":
ISO-8601 UTC, ...}``.  The same parsing function serves a file source (JSON lines)
and a Kafka source (``CAST(value AS STRING)``), so only the source changes
between tests and production.

Exactly-once: every query has its own checkpoint folder under the shared
``spark.checkpoint.dir``; sinks are the file sink (transactional log) or
``foreachBatch`` writing one folder per batch id with overwrite (idempotent on
replay).
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.session import scratch_path

# Fixed value: ISO-8601 UTC text with microseconds, e.g. 2024-01-01T00:00:07.179575Z.
ISO_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSX"

# Fixed value: what producers send, with ``Z`` or an offset, and a fraction only where it is not zero.
ISO_PATTERN = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d{1,6})?(Z|[+-]\d{2}:?\d{2})$"

EVENT_SCHEMA = "event_id BIGINT, user_id BIGINT, event_type STRING, timestamp STRING, value DOUBLE"


def to_event_json(events: DataFrame) -> DataFrame:
    """One JSON ``value`` per event (what a producer publishes)."""
    ts_text = F.date_format(F.col("ts").cast("timestamp"), ISO_FORMAT)
    return events.select(
        F.to_json(
            F.struct(
                F.col("event_id"), F.col("user_id"), F.col("event_type"), ts_text.alias("timestamp"), F.col("value")
            )
        ).alias("value")
    )


def stamped_now(events: DataFrame) -> DataFrame:
    """What a producer sends when something happens: the type and the current UTC time as ISO text."""
    now = F.date_format(F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return events.select(F.to_json(F.struct("event_type", F.concat(now, F.lit("+00:00")).alias("timestamp"))).alias("value"))


def publish_batch(events: DataFrame, path: str, files: int | None = None) -> str:
    """Write events as JSON lines (batch producer).  Returns the folder.

    With ``files`` they are published in event order: that many files, each a range of event
    times and sorted by them, whose modification times rise with the ranges.  A stream takes
    files by modification time, so with any ``max_files`` a micro-batch holds only events
    later than those before it, and the watermark drops none that one batch would keep.
    (The store must keep modification times, as HDFS and local disks do.)
    """
    if not files:
        to_event_json(events).write.mode("overwrite").text(path)
        return path
    ordered = events.repartitionByRange(files, F.col("ts").asc_nulls_first()).sortWithinPartitions(F.col("ts").asc_nulls_first())
    to_event_json(ordered).write.mode("overwrite").text(path)
    _stamp_by_name(events.sparkSession, path)
    return path


def _stamp_by_name(spark: SparkSession, path: str) -> None:
    """Modification times a second apart, in the order of the part files' names, the last one now."""
    jvm = spark._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    parts = sorted((f.getPath() for f in fs.listStatus(folder) if f.getPath().getName().startswith("part-")), key=lambda p: p.getName())
    now = int(jvm.System.currentTimeMillis())
    for k, part in enumerate(parts, start=1):  # a file for each micro-batch's share, never one a row
        fs.setTimes(part, now - 1000 * (len(parts) - k), -1)


def parse_events(raw: DataFrame, value: str = "value") -> DataFrame:
    """Parse JSON values; adds ``ts`` and ``is_valid`` (bad JSON or timestamp → False)."""
    p = raw.select(F.col(value).alias("raw"), F.from_json(F.col(value), EVENT_SCHEMA).alias("e"))
    text = F.col("e.timestamp")
    # with a zone offset or Z, and with or without a fraction; anything else is not valid
    dated = F.when(text.rlike(ISO_PATTERN), text)
    ts = F.coalesce(F.try_to_timestamp(dated, F.lit(ISO_FORMAT)), F.try_to_timestamp(dated))
    out = p.select("raw", "e.*", ts.alias("ts"))
    return out.withColumn("is_valid", F.col("ts").isNotNull() & F.col("event_type").isNotNull())


def read_event_stream(
    spark: SparkSession,
    path: str | None = None,
    max_files: int | None = None,
    kafka_options: dict[str, str] | None = None,
) -> DataFrame:
    """Streaming source with the parse applied: JSON lines from a folder, or — with
    ``kafka_options`` (``kafka.bootstrap.servers``, ``subscribe``, …) — the topic's
    ``value`` bytes cast to text.  The Kafka path needs the connector on the cluster's
    classpath; it is not installed in this environment and is not exercised by tests."""
    if kafka_options:
        raw = spark.readStream.format("kafka").options(**kafka_options).load()
        return parse_events(raw.select(F.col("value").cast("string").alias("value")))
    r = spark.readStream.format("text")
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return parse_events(r.load(path))


def publish_stream(
    stream: DataFrame,
    checkpoint: str,
    path: str | None = None,
    kafka_options: dict[str, str] | None = None,
    available_now: bool = False,
):
    """Publish a ``value`` column continuously — JSON-lines files (file sink,
    exactly-once) or a Kafka topic (at-least-once; needs the connector).  Returns the
    started query."""
    w = stream.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
    if available_now:
        w = w.trigger(availableNow=True)
    if kafka_options:
        return w.format("kafka").options(**kafka_options).start()
    return w.format("text").option("path", path).start()


def windowed_counts(events: DataFrame, window: str = "1 day", watermark: str = "1 hour") -> DataFrame:
    """Counts per event type per tumbling window.  In append mode rows later than the
    watermark are dropped and a window is emitted once the watermark passes its end."""
    return (
        events.filter("is_valid")
        .withWatermark("ts", watermark)
        .groupBy(F.window("ts", window), "event_type")
        .agg(F.count(F.lit(1)).alias("n"))
        .select(
            F.col("window.start").cast("timestamp_ntz").alias("window_start"),
            F.col("window.end").cast("timestamp_ntz").alias("window_end"),
            "event_type",
            "n",
        )
    )


def session_counts(events: DataFrame, gap: str = "30 minutes", watermark: str = "1 hour") -> DataFrame:
    """Per-user session windows; in append mode only sessions closed by the watermark are emitted."""
    return (
        events.filter("is_valid")
        .withWatermark("ts", watermark)
        .groupBy(F.session_window("ts", gap), "user_id")
        .agg(F.count(F.lit(1)).alias("n_events"))
        .select(
            "user_id",
            F.col("session_window.start").cast("timestamp_ntz").alias("session_start"),
            F.col("session_window.end").cast("timestamp_ntz").alias("session_end"),
            "n_events",
        )
    )


def hot_session_counts(events: DataFrame, gap_minutes: int = 30, watermark: str = "1 hour") -> DataFrame:
    """T3 for users of very many events: sessions without one task holding a user's events.

    Stage 1 keeps state by (user, slot), a slot being as long as the gap, so a user's events
    are spread over slots and partially counted before the shuffle.  Events of one slot are
    never a gap apart, so its count, first and last time are all that sessions need.
    Stage 2 keeps state by user and chains slots that follow each other; a chain holds a row
    a slot, however many events there are.  A closed chain is split where the first
    time of a slot is a gap or more after the last time of the slot before.

    Append mode: a chain is emitted once the watermark has passed the slot after its last one.
    """
    gap = f"{gap_minutes} minutes"
    slots = (
        events.filter("is_valid")
        .withWatermark("ts", watermark)
        .groupBy("user_id", F.window("ts", gap))
        .agg(F.count(F.lit(1)).alias("n"), F.min("ts").alias("first"), F.max("ts").alias("last"))
    )
    row = F.struct("first", "last", "n")
    chains = (
        slots.groupBy("user_id", F.session_window(F.window_time("window"), f"{gap_minutes * 60 + 1} seconds"))
        .agg(F.array_sort(F.collect_list(row)).alias("slots"))
    )
    far = f"INTERVAL {gap_minutes} MINUTES"
    # each slot joins the last session of those before it, or opens the next one
    joined = f"""aggregate(slots, CAST(array() AS ARRAY<STRUCT<first: TIMESTAMP, last: TIMESTAMP, n: BIGINT>>), (done, s) ->
        CASE WHEN size(done) > 0 AND s.first < element_at(done, -1).last + {far}
        THEN concat(slice(done, 1, size(done) - 1), array(named_struct('first', element_at(done, -1).first, 'last', s.last, 'n', element_at(done, -1).n + s.n)))
        ELSE concat(done, array(named_struct('first', s.first, 'last', s.last, 'n', s.n))) END)"""
    return chains.select("user_id", F.explode(F.expr(joined)).alias("s")).select(
        "user_id",
        F.col("s.first").cast("timestamp_ntz").alias("session_start"),
        (F.col("s.last") + F.expr(far)).cast("timestamp_ntz").alias("session_end"),
        F.col("s.n").alias("n_events"),
    )


def run_to_changelog(stream: DataFrame, out: str, checkpoint: str, mode: str = "update") -> None:
    """Run a streaming aggregate over all available input, writing each micro-batch's
    rows to ``out/batch_id=N`` (overwrite → idempotent when a batch is replayed).

    Update mode emits every changed row each batch; note that it uses the watermark
    only to evict state — a late row whose window is still in state is merged.  Use
    append mode (``run_to_files``) when late rows must be dropped."""

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    q = (
        stream.writeStream.outputMode(mode)
        .foreachBatch(write_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()


def latest_per_key(spark: SparkSession, out: str, keys: list[str]) -> DataFrame:
    """Fold an update-mode changelog: the row of the highest batch id per key wins."""
    log = spark.read.parquet(out)
    rest = [c for c in log.columns if c not in keys and c != "batch_id"]
    return log.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.col("batch_id")).alias("r")).select(*keys, "r.*")


def run_to_files(stream: DataFrame, out: str, checkpoint: str, fmt: str = "parquet", mode: str = "append") -> None:
    """T4: file sink (exactly-once through its metadata log), all available input."""
    q = (
        stream.writeStream.outputMode(mode)
        .format(fmt)
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()


def run_with_quarantine(events: DataFrame, out: str, checkpoint: str) -> tuple[DataFrame, DataFrame]:
    """Route a parsed event stream in one pass, all available input; (valid events, malformed raw values).

    Each micro-batch is read once and written once, to ``out/batch_id=N`` with a folder for either
    side.  A replayed batch overwrites its own folder, so both sides stay exactly once.
    Returned are the table's two sides; a read of one does not touch the other's files.
    """
    kept = [c for c in events.columns if c not in ("raw", "is_valid")]
    routed = events.select(*(F.when(F.col("is_valid"), F.col(c)).alias(c) for c in kept), F.when(~F.col("is_valid"), F.col("raw")).alias("raw"), "is_valid")

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").partitionBy("is_valid").parquet(f"{out}/batch_id={batch_id}")

    q = routed.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    schema = T.StructType([*routed.schema.fields, T.StructField("batch_id", T.LongType())])
    table = events.sparkSession.read.schema(schema).parquet(out)
    return table.where("is_valid").select(*kept, "batch_id"), table.where("NOT is_valid").select("raw", "batch_id")


def new_run_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint dir for one streaming run."""
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex[:12]}")


def event_kind(event_type: Column) -> Column:
    """The two published kinds: purchases are ``order`` events, everything else ``navigation``."""
    return F.when(event_type == "purchase", "order").otherwise("navigation")
