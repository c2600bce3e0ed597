"""Relational odds and ends: reduces, distinct, dedup, pivots, JSON, set ops, fills,
UDF surface, graph degree (A*, O6, X1–X4, P*, F25/F26, U2/U3, C10, L5)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewater.functions.columns import money
from tidewater.functions.text import neighbour_count
from tidewater.functions.udfs import name_code, phone_or_null, register_normalize_phone
from tidewater.operators import aggregate as agg
from tidewater.operators import layout, sets
from tidewater.plans.registry import register
from tidewater.sources.sinks import register_view
from tidewater.sources.tables import Tables


@register(
    "global_reduce",
    """SELECT sum(l_quantity) AS sum_value, max(l_quantity) AS max_value, min(l_quantity) AS min_value,
  count(l_quantity) AS count_value, count(*) AS count_rows, coalesce(sum(l_quantity), 0) AS fold_value FROM lineitem""",
    "A10 A12 A13 A14",
)
def global_reduce(spark, sf):
    return agg.global_reduce(Tables(spark, sf).lineitem, "l_quantity")


@register("distinct_segments", "SELECT DISTINCT c_mktsegment FROM customer", "A15 P1")
def distinct_segments(spark, sf):
    return Tables(spark, sf).customer.select("c_mktsegment").distinct()


@register("count_by_event_type", "SELECT event_type, count(*) AS count FROM events GROUP BY event_type", "A5 A4 A1")
def count_by_event_type(spark, sf):
    return agg.count_by(Tables(spark, sf).events, "event_type")


@register(
    "duplicate_texts",
    """SELECT sha256(text) AS text_sha256, count(*) AS copies, min(doc_id) AS first_doc_id
FROM documents GROUP BY sha256(text) HAVING count(*) > 1""",
    "A17 A1",
)
def duplicate_texts(spark, sf):
    """Exact duplicate texts.  Grouped on a SHA-256 of the whole text so the shuffle
    carries 64 hex chars per distinct text per map task, not the text itself."""
    d = Tables(spark, sf, spread=True).documents.select("doc_id", F.sha2("text", 256).alias("text_sha256"))
    return d.groupBy("text_sha256").agg(
        F.count(F.lit(1)).alias("copies"), F.min("doc_id").alias("first_doc_id")
    ).filter(F.col("copies") > 1)


@register(
    "dedup_texts",
    """SELECT doc_id, lang, source, n_chars FROM (
  SELECT doc_id, lang, source, n_chars,
         row_number() OVER (PARTITION BY sha256(text) ORDER BY doc_id) AS rn FROM documents) x WHERE rn = 1""",
    "A16",
)
def dedup_texts(spark, sf):
    """Keep the lowest ``doc_id`` per distinct text (deterministic survivor, skew-safe)."""
    d = Tables(spark, sf, spread=True).documents.select(
        F.sha2("text", 256).alias("h"), "doc_id", "lang", "source", "n_chars"
    )
    return agg.keep_one_per_key(d, "h", ["doc_id"]).drop("h")


_EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]


@register(
    "pivot_events",
    "SELECT CAST(ts AS DATE) AS day, "
    + ", ".join(
        f"CAST(sum(CAST(value AS DECIMAL(18,2))) FILTER (WHERE event_type = '{t}') AS DECIMAL(28,2)) AS {t}" for t in _EVENT_TYPES
    )
    + " FROM events GROUP BY 1",
    "A23",
)
def pivot_events(spark, sf):
    """Value per day (rows) × event type (columns); the types present become the columns."""
    e = Tables(spark, sf).events.select(F.col("ts").cast("date").alias("day"), "event_type", money("value").alias("v"))
    return agg.pivot_sum(e, "day", "event_type", None, F.sum("v"))


@register(
    "pivot_month_status",
    """SELECT strftime(o_orderdate, '%b') AS month,
  CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) FILTER (WHERE o_orderstatus = 'F') AS DECIMAL(28,2)) AS F,
  CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) FILTER (WHERE o_orderstatus = 'O') AS DECIMAL(28,2)) AS O,
  CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) FILTER (WHERE o_orderstatus = 'P') AS DECIMAL(28,2)) AS P
FROM orders GROUP BY 1""",
    "A23 O6 P4",
)
def pivot_month_status(spark, sf):
    """A23 + O6: month-name rows in calendar order (CASE sort key, then dropped)."""
    o = Tables(spark, sf).orders.select(
        F.date_format("o_orderdate", "MMM").alias("month"), "o_orderstatus", money("o_totalprice").alias("v")
    )
    p = agg.pivot_sum(o, "month", "o_orderstatus", None, F.sum("v"))
    return p.withColumn("month_num", agg.calendar_order("month")).orderBy("month_num").drop("month_num")


@register(
    "json_props",
    """SELECT event_type, CAST(sum(CAST(json_extract_string(props, '$.k') AS INTEGER)) AS BIGINT) AS sum_k,
  max(CAST(json_extract_string(props, '$.k') AS INTEGER)) AS max_k, count(*) AS n FROM events GROUP BY event_type""",
    "F25 P25",
)
def json_props(spark, sf):
    """``from_json`` with a declared schema (malformed → NULL struct), nested access."""
    e = Tables(spark, sf).events.select("event_type", F.from_json("props", "k INT").alias("p"))
    return e.groupBy("event_type").agg(
        F.sum("p.k").alias("sum_k"), F.max("p.k").alias("max_k"), F.count(F.lit(1)).alias("n")
    )


@register(
    "json_roundtrip",
    """SELECT event_id, user_id, event_type, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events""",
    "F26 F25 P25 K11",
)
def json_roundtrip(spark, sf):
    """F26 → F25: build a nested JSON document per event (``to_json``) and flatten it back
    with ``from_json`` + ``col('a.b.c')``."""
    e = Tables(spark, sf).events
    doc = F.to_json(
        F.struct(
            F.col("event_id"),
            F.struct(
                F.col("user_id").alias("id"),
                F.struct(F.col("event_type").alias("type"), F.from_json("props", "k INT").alias("props")).alias("event"),
            ).alias("user"),
        )
    )
    schema = "event_id BIGINT, user STRUCT<id: BIGINT, event: STRUCT<type: STRING, props: STRUCT<k: INT>>>"
    parsed = e.select(F.from_json(doc, schema).alias("j"))
    return parsed.select(
        F.col("j.event_id").alias("event_id"),
        F.col("j.user.id").alias("user_id"),
        F.col("j.user.event.type").alias("event_type"),
        F.col("j.user.event.props.k").alias("k"),
    )


# ---- X1–X4: set operations ---------------------------------------------------------------

_A = "(SELECT o_custkey AS key FROM orders WHERE o_orderpriority = '1-URGENT')"
_B = "(SELECT c_custkey AS key FROM customer WHERE c_mktsegment = 'BUILDING')"


def _ab(spark, sf):
    t = Tables(spark, sf)
    a = t.orders.filter(F.col("o_orderpriority") == "1-URGENT").select(F.col("o_custkey").alias("key"))
    b = t.customer.filter(F.col("c_mktsegment") == "BUILDING").select(F.col("c_custkey").alias("key"))
    return a, b


@register("set_union_all", f"SELECT key FROM {_A} a UNION ALL SELECT key FROM {_B} b", "X1")
def set_union_all(spark, sf):
    return sets.union_all(*_ab(spark, sf))


@register("set_intersection", f"SELECT key FROM {_A} a INTERSECT SELECT key FROM {_B} b", "X2")
def set_intersection(spark, sf):
    return sets.intersection(*_ab(spark, sf))


@register(
    "set_subtract",
    f"SELECT key FROM {_A} a WHERE NOT EXISTS (SELECT 1 FROM {_B} b WHERE b.key IS NOT DISTINCT FROM a.key)",
    "X3",
)
def set_subtract(spark, sf):
    return sets.subtract_all_copies(*_ab(spark, sf))


@register(
    "set_symmetric_difference",
    f"""SELECT key FROM {_A} a WHERE NOT EXISTS (SELECT 1 FROM {_B} b WHERE b.key IS NOT DISTINCT FROM a.key)
UNION ALL
SELECT key FROM {_B} b WHERE NOT EXISTS (SELECT 1 FROM {_A} a WHERE a.key IS NOT DISTINCT FROM b.key)""",
    "X4",
)
def set_symmetric_difference(spark, sf):
    return sets.symmetric_difference(*_ab(spark, sf))


# ---- P19–P21: NULL handling on documents ⟕ labels --------------------------------------

_DOC_LABELS = "(SELECT d.doc_id, l.quality, l.toxic FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"


def _doc_labels(spark, sf):
    t = Tables(spark, sf)
    return t.documents.select("doc_id").join(t.labels, "doc_id", "left")


@register(
    "fill_mean_quality",
    f"""SELECT doc_id, coalesce(CAST(quality AS DOUBLE), (SELECT avg(CAST(quality AS DOUBLE)) FROM {_DOC_LABELS} y))
  AS quality FROM {_DOC_LABELS} x""",
    "P21 A9 J3",
)
def fill_mean_quality(spark, sf):
    return agg.fill_with_mean(_doc_labels(spark, sf), "quality").select("doc_id", "quality")


@register(
    "drop_null_labels",
    f"SELECT doc_id, quality, toxic FROM {_DOC_LABELS} x WHERE quality IS NOT NULL AND toxic IS NOT NULL",
    "P19 P18",
)
def drop_null_labels(spark, sf):
    return _doc_labels(spark, sf).dropna(subset=["quality", "toxic"])


@register(
    "fill_zero_labels",
    f"SELECT doc_id, coalesce(quality, 0) AS quality, coalesce(toxic, 0) AS toxic FROM {_DOC_LABELS} x",
    "P20",
)
def fill_zero_labels(spark, sf):
    return _doc_labels(spark, sf).fillna(0, subset=["quality", "toxic"])


# ---- projections / filters / UDF surface ---------------------------------------------

@register(
    "line_transforms",
    """SELECT l_orderkey, l_linenumber, l_linenumber * l_linenumber AS squared,
  'num_' || CAST(l_linenumber AS VARCHAR) AS tag, l_returnflag || CAST(length(l_returnflag) AS VARCHAR) AS flag_len
FROM lineitem WHERE l_linenumber % 2 = 0 AND (l_quantity > 5 OR l_discount = 0) AND l_tax BETWEEN 0.0 AND 0.08""",
    "P1 P2 P5 P6 P7 P9 P10 P11 P12 P17 F9 F13 F29",
)
def line_transforms(spark, sf):
    """RDD-era map/filter steps as one projection: square, string prefix, token + length,
    modulo filter, compound AND/OR, inclusive range."""
    li = Tables(spark, sf).lineitem
    return li.filter(
        (F.col("l_linenumber") % 2 == 0)
        & ((F.col("l_quantity") > 5) | (F.col("l_discount") == 0))
        & F.col("l_tax").between(0.0, 0.08)
    ).select(
        "l_orderkey",
        "l_linenumber",
        (F.col("l_linenumber") * F.col("l_linenumber")).alias("squared"),
        F.concat(F.lit("num_"), F.col("l_linenumber").cast("string")).alias("tag"),
        F.concat(F.col("l_returnflag"), F.length("l_returnflag").cast("string")).alias("flag_len"),
    )


@register(
    "balance_sql",
    "SELECT c_custkey, c_acctbal + 10 AS bal_plus_10 FROM customer WHERE c_acctbal >= 18",
    "P13 P2 K7",
)
def balance_sql(spark, sf):
    """SQL ``WHERE`` over a temp view, arithmetic projection."""
    view = register_view(Tables(spark, sf).customer)
    return spark.sql(f"SELECT c_custkey, c_acctbal + 10 AS bal_plus_10 FROM {view} WHERE c_acctbal >= 18")


@register(
    "name_codes",
    """SELECT c_custkey, substr(split_part(c_name, '#', 1), 1, 1) || split_part(c_name, '#', 2)
  || CASE WHEN length(CAST(c_nationkey AS VARCHAR)) >= 2
          THEN substr(CAST(c_nationkey AS VARCHAR), length(CAST(c_nationkey AS VARCHAR)) - 1, 1) ELSE '' END AS username
FROM customer""",
    "U2 F29 F1",
)
def name_codes(spark, sf):
    """U2 natively: first initial + last part + tens digit of a two-digit number."""
    c = Tables(spark, sf).customer
    first = F.split_part("c_name", F.lit("#"), F.lit(1))
    last = F.split_part("c_name", F.lit("#"), F.lit(2))
    return c.select("c_custkey", name_code(first, last, F.col("c_nationkey")).alias("username"))


_PHONE_SQL = """'+1 (' || lpad(CAST(c_nationkey + 100 AS VARCHAR), 3, '0') || ') '
  || substr(lpad(CAST(c_custkey AS VARCHAR), 7, '0'), 1, 3) || '-' || substr(lpad(CAST(c_custkey AS VARCHAR), 7, '0'), 4, 4)"""


@register(
    "normalized_phones",
    f"""SELECT c_custkey, regexp_replace({_PHONE_SQL}, '[^0-9]', '', 'g') AS phone,
  CASE WHEN length(regexp_replace({_PHONE_SQL}, '[^0-9]', '', 'g')) BETWEEN 10 AND 15
       THEN regexp_replace({_PHONE_SQL}, '[^0-9]', '', 'g') END AS valid_phone FROM customer""",
    "U3 F14 F32",
)
def normalized_phones(spark, sf):
    """U3 via a SQL function + F32 (length-checked digits)."""
    fn = register_normalize_phone(spark)
    c = Tables(spark, sf).customer
    key = F.lpad(F.col("c_custkey").cast("string"), 7, "0")
    raw = F.concat(
        F.lit("+1 ("), F.lpad((F.col("c_nationkey") + 100).cast("string"), 3, "0"), F.lit(") "),
        F.substring(key, 1, 3), F.lit("-"), F.substring(key, 4, 4),
    )
    return c.select("c_custkey", F.call_function(fn, raw).alias("phone"), phone_or_null(raw).alias("valid_phone"))


# ---- C10: least-connected nodes -------------------------------------------------------

def graph_lines(spark, sf):
    """Adjacency text ``id nbr nbr …`` derived from lineitem: node = part, neighbours =
    supplier (and the order on odd line numbers); a node spans many lines, some lines
    carry trailing spaces."""
    li = Tables(spark, sf).lineitem
    line = F.when(
        F.col("l_linenumber") % 2 == 1,
        F.concat_ws(" ", F.col("l_partkey").cast("string"), F.col("l_suppkey").cast("string"), F.col("l_orderkey").cast("string")),
    ).otherwise(F.concat(F.col("l_partkey").cast("string"), F.lit(" "), F.col("l_suppkey").cast("string"), F.lit("  ")))
    return li.select(line.alias("value"))


@register(
    "least_connected",
    """WITH c AS (SELECT l_partkey AS id, CAST(sum(CASE WHEN l_linenumber % 2 = 1 THEN 2 ELSE 1 END) AS BIGINT) AS connections
           FROM lineitem GROUP BY l_partkey)
SELECT c.id, c.connections, coalesce(p.p_name, 'Unknown') AS name FROM c LEFT JOIN part p ON c.id = p.p_partkey
WHERE c.connections = (SELECT min(connections) FROM c)""",
    "C10 A11 A25 A10 F1 F2 F3 F10",
)
def least_connected(spark, sf):
    """Nodes with the fewest connections (ties kept), names attached."""
    lines = graph_lines(spark, sf)
    deg = lines.select(*[c.alias(n) for n, c in neighbour_count("value").items()])
    deg = deg.groupBy("id").agg(F.sum("connections").alias("connections"))
    low = agg.rows_at_minimum(deg, "connections")
    names = Tables(spark, sf).part.select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name"))
    return low.join(names, "id", "left").withColumn("name", F.coalesce("name", F.lit("Unknown")))


@register(
    "partition_histogram",
    """SELECT * FROM (VALUES ('spread'), ('spread by key'), ('narrow')) AS t(layout),
  (SELECT count(*) AS n_rows, TRUE AS within_limit, CAST(0 AS BIGINT) AS split_keys, TRUE AS is_even FROM lineitem)""",
    "L1 L2 L3 L5",
)
def partition_histogram_q(spark, sf):
    """Rows per partition of three layouts of lineitem: raised to 16 partitions (L1), hashed by order
    key into 16 (L2), narrowed to 2 without a shuffle (L3).  What holds of any layout is checked: all rows are there,
    no more partitions than asked for, no key in two partitions where it is the key, and an even spread where there is none."""
    li = Tables(spark, sf).lineitem.select("l_orderkey")
    spread = layout.spread(li, 16)
    layouts = {"spread": (spread, 16), "spread by key": (layout.spread(li, 16, "l_orderkey"), 16), "narrow": (layout.narrow(spread, 2), 2)}
    out = []
    for name, (df, limit) in layouts.items():
        parts = layout.partition_histogram(df)
        total = parts.agg(F.sum("rows").alias("n_rows"), (F.max("partition_id") < limit).alias("within_limit"), F.max("rows").alias("most"))
        even = (F.col("most") <= F.ceil(F.col("n_rows") / limit) + limit) if name == "spread" else F.lit(True)
        split = df.withColumn("part", F.spark_partition_id()).groupBy("l_orderkey").agg(F.count_distinct("part").alias("n")).where("n > 1").agg(F.count(F.lit(1))).scalar() if name == "spread by key" else F.lit(0).cast("long")
        out.append(total.select(F.lit(name).alias("layout"), "n_rows", "within_limit", split.alias("split_keys"), even.alias("is_even")))
    return out[0].union(out[1]).union(out[2])
