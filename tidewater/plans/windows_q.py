"""Window queries (W1–W8) over orders per customer and events per user."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewater.functions.columns import money
from tidewater.operators import windows as W
from tidewater.plans.registry import register
from tidewater.sources.tables import Tables


@register(
    "top_per_group",
    """SELECT o_custkey, o_orderkey, o_totalprice, CAST(rnk AS INTEGER) AS rnk FROM (
  SELECT o_custkey, o_orderkey, o_totalprice,
         row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rnk
  FROM orders) x WHERE rnk = 1""",
    "W1 O1",
)
def top_per_group(spark, sf):
    """The largest order of every customer (unique tie-break on the order key)."""
    o = Tables(spark, sf).orders.select("o_custkey", "o_orderkey", "o_totalprice")
    return W.top_n_per_group(o, "o_custkey", [F.col("o_totalprice").desc(), F.col("o_orderkey")], n=1)


@register(
    "top3_with_ties",
    """SELECT o_custkey, o_orderkey, o_orderpriority, CAST(rnk AS INTEGER) AS rnk FROM (
  SELECT o_custkey, o_orderkey, o_orderpriority,
         rank() OVER (PARTITION BY o_custkey ORDER BY o_orderpriority) AS rnk
  FROM orders) x WHERE rnk <= 3""",
    "W2",
)
def top3_with_ties(spark, sf):
    """Top-3 with ties kept (``rank() <= 3``); ties are frequent on the priority."""
    o = Tables(spark, sf).orders.select("o_custkey", "o_orderkey", "o_orderpriority")
    return W.top_ranks(o, "o_custkey", ["o_orderpriority"], 3)


@register(
    "rank_all",
    """SELECT o_custkey, o_orderkey, o_orderpriority,
  CAST(rank() OVER (PARTITION BY o_custkey ORDER BY o_orderpriority) AS INTEGER) AS rnk,
  CAST(dense_rank() OVER (PARTITION BY o_custkey ORDER BY o_orderpriority) AS INTEGER) AS dense_rnk
FROM orders""",
    "W2",
)
def rank_all(spark, sf):
    o = Tables(spark, sf).orders.select("o_custkey", "o_orderkey", "o_orderpriority")
    return W.rank_all(o, "o_custkey", ["o_orderpriority"])


@register(
    "rank_by_date",
    """SELECT o_custkey, o_orderkey, o_orderdate,
  CAST(rank() OVER (PARTITION BY o_custkey ORDER BY o_orderdate) AS INTEGER) AS rnk,
  CAST(dense_rank() OVER (PARTITION BY o_custkey ORDER BY o_orderdate) AS INTEGER) AS dense_rnk
FROM orders""",
    "W2 O1",
)
def rank_by_date(spark, sf):
    """W2 on a many-valued order key: ranks per customer by order date, computed per
    (customer, month) and offset by earlier months — a customer with a third of all
    orders is spread over its months."""
    o = Tables(spark, sf).orders.select("o_custkey", "o_orderkey", "o_orderdate")
    month = F.date_trunc("month", F.col("o_orderdate").cast("timestamp"))
    return W.rank_all(o, "o_custkey", ["o_orderdate"], chunk=month)


@register(
    "running_total",
    """SELECT o_custkey, o_orderkey, o_orderdate,
  sum(CAST(o_totalprice AS DECIMAL(18,2))) OVER (PARTITION BY o_custkey ORDER BY o_orderdate
      RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS running_total
FROM orders""",
    "W3",
)
def running_total(spark, sf):
    """Running spend per customer; peers on the same date share the total (RANGE)."""
    o = Tables(spark, sf).orders.select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice")
    return W.running_total(o, "o_custkey", "o_orderdate", money("o_totalprice")).drop("o_totalprice")


@register(
    "lag_diff_lead",
    """SELECT o_custkey, o_orderkey, o_orderdate, CAST(o_totalprice AS DECIMAL(18,2)) AS amount,
  lag(CAST(o_totalprice AS DECIMAL(18,2))) OVER w AS prev_value,
  lead(CAST(o_totalprice AS DECIMAL(18,2))) OVER w AS next_value,
  CAST(o_totalprice AS DECIMAL(18,2)) - lag(CAST(o_totalprice AS DECIMAL(18,2))) OVER w AS diff_from_prev
FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)""",
    "W4 W5 W6",
)
def lag_diff_lead(spark, sf):
    """Previous / next order amount per customer and the change from the previous one."""
    o = Tables(spark, sf).orders.select(
        "o_custkey", "o_orderkey", "o_orderdate", money("o_totalprice").alias("amount")
    )
    return W.lag_lead(o, "o_custkey", "o_orderdate", "o_orderkey", "amount")


@register(
    "rolling_7d",
    """SELECT event_id, user_id, ts,
  CAST(sum(CAST(value AS DECIMAL(18,2))) OVER w AS DECIMAL(28,2)) AS rolling_sum,
  count(value) OVER w AS rolling_n,
  CAST(sum(CAST(value AS DECIMAL(18,2))) OVER w AS DOUBLE) / count(value) OVER w AS rolling_avg
FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts
  RANGE BETWEEN INTERVAL 7 DAYS PRECEDING AND CURRENT ROW)""",
    "W7",
)
def rolling_7d(spark, sf):
    """7-day rolling mean of event value per user (inclusive look-back)."""
    e = Tables(spark, sf).events.select("event_id", "user_id", "ts", money("value").alias("v"))
    out = W.rolling_mean(e, "user_id", "ts", F.col("v"), "event_id").drop("v")
    # same type as a plain sum over DECIMAL(18,2) (the values always fit)
    return out.withColumn("rolling_sum", F.col("rolling_sum").cast("decimal(28,2)"))


SESSIONS_SQL = """
WITH e AS (SELECT event_id, user_id, ts, CAST(floor(epoch(ts)) AS BIGINT) AS sec FROM events),
l AS (SELECT *, lag(sec) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev FROM e),
f AS (SELECT *, CASE WHEN prev IS NULL OR (sec - prev) / 60.0 > 30 THEN 1 ELSE 0 END AS new_session FROM l)
SELECT event_id, user_id, ts,
  CAST(sum(new_session) OVER (PARTITION BY user_id ORDER BY ts, event_id
       ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS session_id
FROM f"""


@register("sessions", SESSIONS_SQL, "W8 F24 P5")
def sessions(spark, sf):
    """30-minute inactivity sessions per user (exactly 30:00 stays in the session)."""
    e = Tables(spark, sf).events.select("event_id", "user_id", "ts")
    return W.sessionize(e, "user_id", "ts", "event_id", gap_minutes=30).select(
        "event_id", "user_id", "ts", "session_id"
    )


@register(
    "session_summary",
    f"""SELECT user_id, session_id, count(*) AS n_events, min(ts) AS session_start, max(ts) AS session_end
FROM ({SESSIONS_SQL}) s GROUP BY user_id, session_id""",
    "W8 A7",
)
def session_summary(spark, sf):
    """W8 follow-on: one row per session with its size and bounds."""
    s = sessions(spark, sf)
    return s.groupBy("user_id", "session_id").agg(
        F.count(F.lit(1)).alias("n_events"), F.min("ts").alias("session_start"), F.max("ts").alias("session_end")
    )
