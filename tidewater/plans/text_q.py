"""Text queries: word counts (C13), line explode (F5), access-log report (C12), app-log levels.

Log lines are derived from the ``events`` table by Spark (so they grow with it)
and then parsed back with the reference's patterns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.functions import text as T
from tidewater.operators.aggregate import count_by
from tidewater.operators.order import global_rank
from tidewater.plans.registry import register
from tidewater.sources.tables import Tables


def _ranked(counts: DataFrame, key: str) -> DataFrame:
    """Counts with their place, most frequent first; through ranges, as there may be very many keys."""
    return global_rank(counts, F.col("count").desc(), F.col(key).asc_nulls_last())


@register(
    "word_count",
    r"""SELECT word, count(*) AS count, row_number() OVER (ORDER BY count(*) DESC, word) AS rank FROM (
  SELECT unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}_]+(?: ''[\p{L}\p{N}_]+)*')) AS word FROM documents) t
GROUP BY word""",
    "C13 F17 F11 P8 A4 O1 O2",
)
def word_count(spark, sf):
    """C13 normalised: lower-cased word tokens counted over every document, whole texts; the place of
    each word by count (then by itself) is its ``rank``, so the order outlives the result's.

    ``explode`` + ``groupBy`` gives a partial count per map task before the shuffle,
    so a very frequent word costs one row per task.
    """
    d = Tables(spark, sf, spread=True).documents.select(F.explode(T.normalised_words("text")).alias("word"))
    return _ranked(count_by(d, "word", "count"), "word")


@register(
    "word_count_simple",
    r"""SELECT word, count(*) AS count FROM (
  SELECT unnest(regexp_split_to_array(text,
    '[\t\n\x0b\f\r\x1c-\x1f \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+')) AS word
  FROM documents) t WHERE word <> '' GROUP BY word""",
    "C13 P8 A5",
)
def word_count_simple(spark, sf):
    """C13 simple: ``flatMap(str.split)`` + ``countByValue``, kept distributed."""
    d = Tables(spark, sf, spread=True).documents.select(F.explode(T.whitespace_tokens("text")).alias("word"))
    return count_by(d, "word", "count")


@register(
    "doc_lines",
    """SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE length(line) > 0) AS n_nonempty,
  CAST(max(length(line)) AS INTEGER) AS longest_line
FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents) t GROUP BY doc_id""",
    "F5 F1 F13 A1",
)
def doc_lines(spark, sf):
    """explode each document into lines; per-document line statistics."""
    d = Tables(spark, sf, spread=True).documents.select("doc_id", F.explode(F.split("text", "\n")).alias("line"))
    return d.groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("n_lines"),
        F.count(F.when(F.length("line") > 0, 1)).alias("n_nonempty"),
        F.max(F.length("line")).alias("longest_line"),
    )


# ---- C12: access log ---------------------------------------------------------------

def access_log_lines(events: DataFrame) -> DataFrame:
    """Render events as common-log-format lines (one ``value`` column, like ``read.text``)."""
    k = F.get_json_object("props", "$.k").cast("int")
    status = (
        F.when(F.col("event_type") == "error", "500").when(k < 10, "404").when(k < 15, "403").otherwise("200")
    )
    ip = F.concat_ws(".", F.lit("10"), F.lit("0"), (F.col("user_id") % 256).cast("string"), (F.col("event_id") % 4).cast("string"))
    endpoint = F.concat(F.lit("/"), F.col("event_type"), F.lit("/"), k.cast("string"))
    return events.select(
        F.concat(
            ip, F.lit(" - - ["), F.date_format("ts", "dd/MMM/yyyy:HH:mm:ss"), F.lit(' +0000] "GET '),
            endpoint, F.lit(' HTTP/1.1" '), status, F.lit(" "), (F.col("event_id") % 5000).cast("string"),
        ).alias("value")
    )


def parsed_access_log(spark, sf) -> DataFrame:
    lines = access_log_lines(Tables(spark, sf, spread=True).events)
    return lines.select(*[c.alias(n) for n, c in T.access_log_fields("value").items()])


_LOG_SQL = """(SELECT '10.0.' || CAST(user_id % 256 AS VARCHAR) || '.' || CAST(event_id % 4 AS VARCHAR) AS ip,
   '/' || event_type || '/' || CAST(CAST(json_extract_string(props, '$.k') AS INTEGER) AS VARCHAR) AS endpoint,
   CASE WHEN event_type = 'error' THEN '500' WHEN CAST(json_extract_string(props, '$.k') AS INTEGER) < 10 THEN '404'
        WHEN CAST(json_extract_string(props, '$.k') AS INTEGER) < 15 THEN '403' ELSE '200' END AS status
 FROM events)"""


@register("access_log_by_ip", f"SELECT ip, count(*) AS count, row_number() OVER (ORDER BY count(*) DESC, ip) AS rank FROM {_LOG_SQL} l GROUP BY ip", "C12 F16 A1 O1 O2")
def access_log_by_ip(spark, sf):
    return _ranked(count_by(parsed_access_log(spark, sf), "ip"), "ip")


@register(
    "access_log_by_endpoint", f"SELECT endpoint, count(*) AS count, row_number() OVER (ORDER BY count(*) DESC, endpoint) AS rank FROM {_LOG_SQL} l GROUP BY endpoint", "C12 F16 A1 O1 O2"
)
def access_log_by_endpoint(spark, sf):
    return _ranked(count_by(parsed_access_log(spark, sf), "endpoint"), "endpoint")


@register("access_log_by_status", f"SELECT status, count(*) AS count, row_number() OVER (ORDER BY count(*) DESC, status) AS rank FROM {_LOG_SQL} l GROUP BY status", "C12 F16 A1 O1 O2")
def access_log_by_status(spark, sf):
    return _ranked(count_by(parsed_access_log(spark, sf), "status"), "status")


@register(
    "ok_hits_by_endpoint",
    f"SELECT endpoint, count(*) AS count FROM {_LOG_SQL} l WHERE status = '200' GROUP BY endpoint",
    "A24 P15 P10",
)
def ok_hits_by_endpoint(spark, sf):
    """Status-200 hits per endpoint (filter → count per key)."""
    return count_by(parsed_access_log(spark, sf).filter(F.col("status") == "200"), "endpoint")


# ---- F33: application log levels -------------------------------------------------------

def app_log_lines(events: DataFrame) -> DataFrame:
    """``date time LEVEL message`` lines rendered from events."""
    level = F.when(F.col("event_type") == "error", "ERROR").when(F.col("event_type") == "signup", "WARN").otherwise("INFO")
    k = F.get_json_object("props", "$.k")
    msg = F.concat_ws(" ", F.lit("user"), F.col("user_id").cast("string"), F.col("event_type"), F.concat(F.lit("k="), k))
    return events.select(
        F.concat_ws(" ", F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), level, msg).alias("value")
    )


_APP_SQL = """(SELECT CASE WHEN event_type = 'error' THEN 'ERROR' WHEN event_type = 'signup' THEN 'WARN' ELSE 'INFO' END AS level,
  'user ' || CAST(user_id AS VARCHAR) || ' ' || event_type || ' k=' || json_extract_string(props, '$.k') AS message
 FROM events)"""


@register("log_levels", f"SELECT level, count(*) AS n_lines FROM {_APP_SQL} l GROUP BY level", "F33 P15 A4")
def log_levels(spark, sf):
    lines = app_log_lines(Tables(spark, sf, spread=True).events).select(*[c.alias(n) for n, c in T.log_line_fields("value").items()])
    return lines.groupBy("level").agg(F.count(F.lit(1)).alias("n_lines"))


@register(
    "error_messages",
    f"SELECT upper(message) AS message, count(*) AS n FROM {_APP_SQL} l WHERE level = 'ERROR' GROUP BY upper(message)",
    "F33 P14 F11 F4",
)
def error_messages(spark, sf):
    """ERROR lines (prefix test on the level token), message = tokens 4.., upper-cased."""
    lines = app_log_lines(Tables(spark, sf, spread=True).events).select(*[c.alias(n) for n, c in T.log_line_fields("value").items()])
    errs = lines.filter(F.col("level").startswith("ERROR"))
    return errs.groupBy(F.upper("message").alias("message")).agg(F.count(F.lit(1)).alias("n"))
