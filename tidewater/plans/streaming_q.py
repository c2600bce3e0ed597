"""Streaming queries (T1–T4): events are published as JSON lines (derived from the
``events`` table by Spark), consumed by Structured Streaming with ``availableNow``,
and the sink's contents are returned as a batch DataFrame."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewater.plans.registry import register
from tidewater.sources.tables import Tables
from tidewater.streaming import events as S


MICRO_BATCHES = 4


def _published(spark, sf, name):
    """Events published in event order, and the number of files of a micro-batch: MICRO_BATCHES of them hold all."""
    run = S.new_run_dir(spark, name)
    files = max(MICRO_BATCHES, int(spark.conf.get("spark.sql.shuffle.partitions")))
    S.publish_batch(Tables(spark, sf).events, f"{run}/in", files=files)
    return run, -(-files // MICRO_BATCHES)


@register(
    "stream_event_counts",
    """SELECT date_trunc('day', ts) AS window_start, date_trunc('day', ts) + INTERVAL 1 DAY AS window_end,
  event_type, count(*) AS n FROM events
WHERE date_trunc('day', ts) + INTERVAL 1 DAY <= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR
GROUP BY 1, 2, 3""",
    "T2 S17 K11 F21",
)
def stream_event_counts(spark, sf):
    """Daily counts per event type, append mode with a 1-hour watermark: rows later
    than the watermark are dropped and a window is emitted once the watermark passes
    its end (the newest day stays open at the end of the input)."""
    run, share = _published(spark, sf, "event-counts")
    stream = S.windowed_counts(S.read_event_stream(spark, f"{run}/in", max_files=share))
    S.run_to_files(stream, f"{run}/out", f"{run}/ckpt", fmt="parquet", mode="append")
    return spark.read.parquet(f"{run}/out")


@register(
    "stream_sessions",
    """WITH e AS (SELECT user_id, ts, lag(ts) OVER (PARTITION BY user_id ORDER BY ts) AS prev FROM events),
f AS (SELECT *, CASE WHEN prev IS NULL OR ts >= prev + INTERVAL 30 MINUTE THEN 1 ELSE 0 END AS ns FROM e),
g AS (SELECT *, sum(ns) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS sid FROM f),
s AS (SELECT user_id, min(ts) AS session_start, max(ts) + INTERVAL 30 MINUTE AS session_end, count(*) AS n_events
      FROM g GROUP BY user_id, sid)
SELECT user_id, session_start, session_end, n_events FROM s
WHERE session_end <= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR""",
    "T3",
)
def stream_sessions(spark, sf):
    """30-minute session windows per user, append mode: only sessions closed by the
    1-hour watermark are emitted (the newest ones stay open)."""
    run, share = _published(spark, sf, "sessions")
    stream = S.session_counts(S.read_event_stream(spark, f"{run}/in", max_files=share))
    S.run_to_files(stream, f"{run}/out", f"{run}/ckpt", fmt="parquet", mode="append")
    return spark.read.parquet(f"{run}/out")


@register(
    "stream_sessions_hot_user",
    """WITH ev AS (SELECT CASE WHEN event_id % 3 = 0 THEN -1 ELSE user_id END AS user_id, ts FROM events),
sl AS (SELECT DISTINCT user_id, time_bucket(INTERVAL 30 MINUTE, ts) AS slot FROM ev),
ch AS (SELECT user_id, slot, sum(o) OVER (PARTITION BY user_id ORDER BY slot) AS chain FROM (
  SELECT *, CASE WHEN slot = lag(slot) OVER (PARTITION BY user_id ORDER BY slot) + INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS o FROM sl)),
cl AS (SELECT user_id, min(slot) AS from_slot, max(slot) AS to_slot FROM ch GROUP BY user_id, chain
  HAVING max(slot) + INTERVAL 60 MINUTE + INTERVAL 1 SECOND - INTERVAL 1 MICROSECOND <= (SELECT max(ts) FROM ev) - INTERVAL 1 HOUR),
e AS (SELECT user_id, ts, lag(ts) OVER (PARTITION BY user_id ORDER BY ts) AS prev FROM ev),
g AS (SELECT *, sum(CASE WHEN prev IS NULL OR ts >= prev + INTERVAL 30 MINUTE THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS sid FROM e),
s AS (SELECT user_id, min(ts) AS session_start, max(ts) + INTERVAL 30 MINUTE AS session_end, count(*) AS n_events FROM g GROUP BY user_id, sid)
SELECT s.* FROM s JOIN cl ON s.user_id = cl.user_id AND s.session_start >= cl.from_slot AND s.session_start < cl.to_slot + INTERVAL 30 MINUTE""",
    "T3",
)
def stream_sessions_hot_user(spark, sf):
    """T3 where one user has a third of all events: state by (user, half hour), stitched over their edges.

    Emitted are the sessions of chains of half hours that the watermark has closed."""
    run = S.new_run_dir(spark, "hot-sessions")
    files = max(MICRO_BATCHES, int(spark.conf.get("spark.sql.shuffle.partitions")))
    events = Tables(spark, sf).events.withColumn("user_id", F.when(F.col("event_id") % 3 == 0, F.lit(-1)).otherwise(F.col("user_id")))
    S.publish_batch(events, f"{run}/in", files=files)
    stream = S.hot_session_counts(S.read_event_stream(spark, f"{run}/in", max_files=-(-files // MICRO_BATCHES)))
    S.run_to_files(stream, f"{run}/out", f"{run}/ckpt", fmt="parquet", mode="append")
    return spark.read.parquet(f"{run}/out")


@register(
    "stream_quarantine",
    """WITH e AS (SELECT event_id, event_id % 23 = 0 OR event_id % 29 = 0 OR event_id % 31 = 0 AS bad FROM events)
SELECT CASE WHEN bad THEN 'bad' ELSE 'good' END AS side, count(*) AS n, CAST(sum(event_id) AS BIGINT) AS id_sum FROM e GROUP BY 1""",
    "T1 S17 K11",
)
def stream_quarantine(spark, sf):
    """A stream with text that is no JSON, times that are none and events without a type, routed in one
    pass; both sides are counted from the routed table."""
    run = S.new_run_dir(spark, "quarantine")
    k = F.col("event_id")
    ok = S.to_event_json(Tables(spark, sf).events.withColumn("event_type", F.when(k % 31 != 0, F.col("event_type"))))
    spoilt = F.get_json_object("value", "$.event_id").cast("long")
    value = (
        F.when(spoilt % 23 == 0, F.concat(F.lit("no json "), spoilt))
        .when(spoilt % 29 == 0, F.regexp_replace("value", '"timestamp":"[^"]*"', '"timestamp":"yesterday"'))
        .otherwise(F.col("value"))
    )
    ok.select(value.alias("value")).write.text(f"{run}/in")
    good, bad = S.run_with_quarantine(S.read_event_stream(spark, f"{run}/in", max_files=1), f"{run}/out", f"{run}/ckpt")
    of = lambda df, side, i: df.agg(F.count(F.lit(1)).alias("n"), F.sum(i).alias("id_sum")).select(F.lit(side).alias("side"), "n", "id_sum")
    return of(good, "good", F.col("event_id")).union(of(bad, "bad", F.regexp_extract("raw", "[0-9]+", 0).cast("long")))


@register(
    "stream_publish_kinds",
    """SELECT CASE WHEN event_type = 'purchase' THEN 'order' ELSE 'navigation' END AS kind, count(*) AS n
FROM events GROUP BY 1""",
    "T4 T1 K11 K1",
)
def stream_publish_kinds(spark, sf):
    """T4: republish parsed events as ``{kind, timestamp}`` JSON through a file sink,
    then count what was published per kind."""
    run, share = _published(spark, sf, "publish")
    parsed = S.read_event_stream(spark, f"{run}/in", max_files=share).filter("is_valid")
    out = parsed.select(
        F.to_json(F.struct(S.event_kind(F.col("event_type")).alias("kind"), F.col("timestamp"))).alias("value")
    )
    S.run_to_files(out, f"{run}/out", f"{run}/ckpt", fmt="text", mode="append")
    published = spark.read.text(f"{run}/out").select(F.from_json("value", "kind STRING, timestamp STRING").alias("j"))
    return published.groupBy(F.col("j.kind").alias("kind")).agg(F.count(F.lit(1)).alias("n"))
