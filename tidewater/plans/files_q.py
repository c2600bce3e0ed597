"""Queries over files, tables and layouts that Spark derives from the driver tables.

Each writes its input into a fresh folder under the shared checkpoint directory and
reads it back through the library.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tidewater.functions.columns import money
from tidewater.operators.layout import persisted
from tidewater.plans import commerce, jobs
from tidewater.plans.registry import register
from tidewater.plans.relational import graph_lines
from tidewater.sources import readers, sinks
from tidewater.sources.tables import Tables
from tidewater.streaming import events as S
from tidewater.streaming.events import new_run_dir


@register(
    "csv_all_strings",
    """SELECT c_mktsegment, count(*) AS n, max(CAST(c_custkey AS VARCHAR)) AS last_key, 'string' AS key_type FROM customer GROUP BY c_mktsegment""",
    "S4 A7",
)
def csv_all_strings(spark, sf):
    """A header CSV without a schema: every column is text, so the largest key is the last in text order."""
    run = new_run_dir(spark, "strings")
    Tables(spark, sf).customer.select("c_custkey", "c_mktsegment").write.option("header", True).csv(f"{run}/in")
    back = readers.read_csv(spark, f"{run}/in")
    key_type = dict(back.dtypes)["c_custkey"]
    return back.groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("n"), F.max("c_custkey").alias("last_key"), F.lit(key_type).alias("key_type"))


@register(
    "csv_inferred_types",
    """SELECT * FROM (SELECT 'c_custkey' AS "column", 'int' AS data_type, count(c_custkey) AS n FROM customer UNION ALL
SELECT 'c_name', 'string', count(c_name) FROM customer UNION ALL
SELECT 'c_acctbal', 'double', count(c_acctbal) FROM customer UNION ALL
SELECT 'since', 'date', count(*) FROM customer)""",
    "S5 P18",
)
def csv_inferred_types(spark, sf):
    """A header CSV whose types Spark infers; the types found, and how many values each column kept."""
    run = new_run_dir(spark, "inferred")
    since = F.date_add(F.lit("2020-01-01").cast("date"), (F.col("c_custkey") % 1000).cast("int")).alias("since")
    Tables(spark, sf).customer.select("c_custkey", "c_name", "c_acctbal", since).write.option("header", True).csv(f"{run}/in")
    back = readers.read_csv(spark, f"{run}/in", infer_schema=True)
    counts = back.agg(*(F.count(c).alias(c) for c in back.columns))
    rows = F.explode(F.array(*(F.struct(F.lit(c).alias("column"), F.lit(t).alias("data_type"), F.col(c).alias("n")) for c, t in back.dtypes)))
    return counts.select(rows.alias("r")).select("r.*")


@register(
    "tab_ratings_popular",
    """WITH r AS (SELECT l_partkey AS item, count(*) AS n, avg(CAST(l_quantity AS DOUBLE)) AS a FROM lineitem GROUP BY l_partkey)
SELECT 'most' AS list, item, p_name AS title, CAST(row_number() OVER (ORDER BY n DESC, item) AS INTEGER) AS rank FROM r JOIN part ON item = p_partkey QUALIFY rank <= 10
UNION ALL
SELECT 'best' AS list, item, p_name AS title, CAST(row_number() OVER (ORDER BY a DESC, item) AS INTEGER) AS rank FROM r JOIN part ON item = p_partkey QUALIFY rank <= 10""",
    "S6 S10 C11 O3",
)
def tab_ratings_popular(spark, sf):
    """Tab-separated ``user item rating ts`` without header and ``|``-separated names, both with a
    declared schema: the most and the best rated items, in order (the job of C11)."""
    run = new_run_dir(spark, "tabs")
    t = Tables(spark, sf)
    t.lineitem.select("l_orderkey", "l_partkey", "l_quantity", "l_linenumber").write.option("sep", "\t").csv(f"{run}/ratings")
    t.part.select("p_partkey", "p_name").write.option("sep", "|").option("encoding", "ISO-8859-1").csv(f"{run}/items")
    out = jobs.popular_items(spark, f"{run}/ratings", f"{run}/items")
    pick = lambda df, name: df.select(F.lit(name).alias("list"), F.col("item").cast("long").alias("item"), "title", "rank")
    return pick(out["most_rated"], "most").union(pick(out["top_rated"], "best"))


@register(
    "least_connected_from_files",
    """WITH c AS (SELECT l_partkey AS id, CAST(sum(CASE WHEN l_linenumber % 2 = 1 THEN 2 ELSE 1 END) AS BIGINT) AS connections
           FROM lineitem GROUP BY l_partkey)
SELECT c.id, c.connections, p.p_name AS name FROM c LEFT JOIN part p ON c.id = p.p_partkey
WHERE c.connections = (SELECT min(connections) FROM c)""",
    "S6 S1 S2 C10 A11",
)
def least_connected_from_files(spark, sf):
    """Adjacency lines as text and space-separated ``id "name"`` rows with a declared schema; the job of C10."""
    run = new_run_dir(spark, "graph")
    graph_lines(spark, sf).write.text(f"{run}/graph")
    Tables(spark, sf).part.select("p_partkey", "p_name").write.option("sep", " ").option("quoteAll", True).csv(f"{run}/names")
    return jobs.least_connected(spark, f"{run}/graph", f"{run}/names").select("id", "connections", "name")


@register(
    "range_squares",
    "SELECT count(*) AS n, CAST(sum(r.range * r.range) AS BIGINT) AS squares, 8 AS partitions FROM range((SELECT count(*) FROM orders)) r",
    "S13 P6 L1",
)
def range_squares(spark, sf):
    """A generated range as long as ``orders``, in eight partitions; squares summed on the executors.

    The sum is below n³/3: a BIGINT as long as that surely holds it, beyond (3.0 million rows) a DECIMAL(38,0)."""
    n = Tables(spark, sf).orders.count()
    return squares_of_range(spark, n, 8)


def squares_of_range(spark, n: int, partitions: int):
    """Length, exact sum of squares and partitions of a generated range."""
    numbers = readers.numbers(spark, 0, n, partitions).withColumn("part", F.spark_partition_id())
    squares = F.sum(F.col("value") * F.col("value"))
    if n**3 // 3 >= 2**63:
        value = F.col("value").cast("decimal(19,0)")
        squares = F.sum(value * value).cast("decimal(38,0)")
    return numbers.agg(
        F.count(F.lit(1)).alias("n"), squares.alias("squares"),
        F.count_distinct("part").cast("int").alias("partitions"),
    )


@register(
    "table_peek",
    "SELECT least(10, count(*)) AS n_peeked, least(10, count(*)) AS n_known, count(*) AS n_rows FROM customer",
    "S14 S15 K8 K9 O7",
)
def table_peek(spark, sf):
    """A saved table read by name; the verification peek gives ten rows (any ten), all of them the table's."""
    run = new_run_dir(spark, "peek")
    db = f"tw_{uuid.uuid4().hex[:8]}"
    sinks.create_database(spark, db, location=f"{run}/db")
    sinks.save_table(Tables(spark, sf).customer.select("c_custkey", "c_name"), f"{db}.customers")
    peek = readers.read_table(spark, f"{db}.customers", limit=10).checkpoint(eager=True)
    full = readers.read_table(spark, f"{db}.customers")
    known = full.join(peek, ["c_custkey", "c_name"], "left_semi").agg(F.count(F.lit(1))).scalar()
    peeked = peek.agg(F.count(F.lit(1))).scalar()
    out = full.agg(F.count(F.lit(1)).alias("n_rows")).select(peeked.alias("n_peeked"), known.alias("n_known"), "n_rows").checkpoint(eager=True)
    sinks.drop_table(spark, f"{db}.customers")
    spark.sql(f"DROP DATABASE IF EXISTS {db}")
    return out


@register(
    "single_file_totals",
    """SELECT o_orderstatus AS status, count(*) AS n, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(28,2)) AS total, 1 AS n_files FROM orders GROUP BY 1""",
    "K6 K1 L3",
)
def single_file_totals(spark, sf):
    """K6: a small result (a row a status) written as one file, counted and read back."""
    run = new_run_dir(spark, "single")
    o = Tables(spark, sf).orders.select(F.col("o_orderstatus").alias("status"), money("o_totalprice").alias("p"))
    sinks.write_parquet(o.groupBy("status").agg(F.count(F.lit(1)).alias("n"), F.sum("p").cast("decimal(28,2)").alias("total")), f"{run}/out", files=1)
    back = spark.read.parquet(f"{run}/out")
    n_files = len(back.inputFiles())
    return back.withColumn("n_files", F.lit(n_files))


@register(
    "rows_to_driver",
    "SELECT r_name AS region, string_agg(n_name, ',' ORDER BY n_name) AS nations, count(*) AS n FROM nation JOIN region ON n_regionkey = r_regionkey GROUP BY r_name",
    "K12 S11 J1 A5",
)
def rows_to_driver(spark, sf):
    """The nations and their regions brought to the driver (bounded, or an error), grouped there in plain Python."""
    t = Tables(spark, sf)
    rows = sinks.to_driver(t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select("r_name", "n_name"), max_rows=1000)
    by: dict[str, list[str]] = {}
    for r in rows:
        by.setdefault(r.r_name, []).append(r.n_name)
    return spark.createDataFrame([(k, ",".join(sorted(v)), len(v)) for k, v in by.items()], "region string, nations string, n long")


@register(
    "orders_by_ordinal",
    "SELECT o_orderstatus AS status, o_orderpriority AS priority, count(*) AS n FROM orders GROUP BY 1, 2",
    "A8 K7 P13",
)
def orders_by_ordinal(spark, sf):
    """Grouping by the places of the selected columns, in SQL."""
    view = sinks.register_view(Tables(spark, sf).orders)
    return spark.sql(f"SELECT o_orderstatus AS status, o_orderpriority AS priority, count(*) AS n FROM {view} GROUP BY 1, 2")


@register(
    "events_stamped_now",
    "SELECT event_type, count(*) AS n, count(*) AS n_now FROM events GROUP BY event_type",
    "F27 K11 F26 F21",
)
def events_stamped_now(spark, sf):
    """an event a row of ``events``, stamped with the current UTC time as ISO text and published; read
    back, each time must parse and lie between the start and the end of the run."""
    run = new_run_dir(spark, "now")
    clock = lambda: spark.range(1).select(F.current_timestamp().alias("t")).first().t
    start = clock()
    S.stamped_now(Tables(spark, sf).events).write.text(f"{run}/in")
    end = clock()
    back = S.parse_events(spark.read.text(f"{run}/in"))
    inside = F.col("is_valid") & F.col("ts").between(F.lit(start), F.lit(end))
    return back.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.count(F.when(inside, 1)).alias("n_now"))


@register(
    "table_descriptions",
    """SELECT * FROM (VALUES (NULL, NULL, 'Customers of the ''cleaned'' feed'), ('c_custkey', 'bigint', 'key'), ('c_name', 'string', 'full name'), ('c_mktsegment', 'string', NULL)) AS t("column", data_type, comment),
  (SELECT count(*) AS n_rows FROM customer)""",
    "K13 K3 K9",
)
def table_descriptions(spark, sf):
    """Comments on a table and its columns, read back from the catalog."""
    run = new_run_dir(spark, "described")
    db = f"tw_{uuid.uuid4().hex[:8]}"
    sinks.create_database(spark, db, location=f"{run}/db")
    sinks.save_table(Tables(spark, sf).customer.select("c_custkey", "c_name", "c_mktsegment"), f"{db}.customers")
    sinks.describe(spark, f"{db}.customers", "Customers of the 'cleaned' feed", {"c_custkey": "key", "c_name": "full name"})
    n = spark.table(f"{db}.customers").count()
    out = sinks.descriptions(spark, f"{db}.customers").withColumn("n_rows", F.lit(n).cast("long"))
    sinks.drop_table(spark, f"{db}.customers")
    spark.sql(f"DROP DATABASE IF EXISTS {db}")
    return out


@register(
    "keyed_inserts",
    """WITH l AS (SELECT c_custkey, c_name, CASE WHEN c_custkey % 3 = 0 THEN 'first' ELSE 'second' END AS load_id FROM customer)
SELECT row_number() OVER (ORDER BY load_id, c_name, c_custkey) AS number_id, c_custkey, c_name, load_id FROM l""",
    "K10 K4 K9 O1",
)
def keyed_inserts(spark, sf):
    """A table with generated keys, two inserts, and the first one run again: the keys are
    dense, the second insert's go on from the first one's, and the replay gives the keys it had."""
    run = new_run_dir(spark, "keyed")
    db = f"tw_{uuid.uuid4().hex[:8]}"
    sinks.create_database(spark, db, location=f"{run}/db")
    name = f"{db}.numbers"
    sinks.create_keyed_table(spark, name, "c_custkey BIGINT, c_name STRING", "number_id")
    c = Tables(spark, sf).customer.select("c_custkey", "c_name")
    loads = {"first": c.where("c_custkey % 3 = 0"), "second": c.where("c_custkey % 3 <> 0")}
    for load in ("first", "second", "first"):
        sinks.insert_with_key(loads[load], name, "number_id", ["c_name", "c_custkey"], load)
    out = spark.table(name).select("number_id", "c_custkey", "c_name", "load_id").checkpoint(eager=True)
    sinks.drop_table(spark, name)
    spark.sql(f"DROP DATABASE IF EXISTS {db}")
    return out


@register(
    "etl_reports_shared",
    """WITH s AS (SELECT o_custkey AS customer_id, CAST(o_totalprice AS DECIMAL(18,2)) AS amount, c_mktsegment AS segment, n_name AS city
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey),
t AS (SELECT customer_id, sum(amount) AS spent FROM s GROUP BY 1 ORDER BY spent DESC, customer_id LIMIT 3)
SELECT 'city' AS report, city AS key, CAST(sum(amount) AS DECIMAL(28,2)) AS total FROM s GROUP BY city
UNION ALL SELECT 'segment', segment, CAST(sum(amount) AS DECIMAL(28,2)) FROM s GROUP BY segment
UNION ALL SELECT 'customer', CAST(customer_id AS VARCHAR), CAST(spent AS DECIMAL(28,2)) FROM t""",
    "L4 C9 A26 O3",
)
def etl_reports_shared(spark, sf):
    """L4: one joined result, persisted while three reports are written from it, then released."""
    run = new_run_dir(spark, "shared")
    joined = commerce.etl_sales(spark, sf)
    total = F.sum("amount").cast("decimal(28,2)").alias("total")
    reports = {
        "city": lambda s: s.groupBy(F.col("city").alias("key")).agg(total),
        "segment": lambda s: s.groupBy(F.col("segment").alias("key")).agg(total),
        "customer": lambda s: s.groupBy(F.col("customer_id").cast("string").alias("key"), "customer_id").agg(total)
        .orderBy(F.col("total").desc(), "customer_id").limit(3).select("key", "total"),
    }
    with persisted(joined) as shared:
        for name, report in reports.items():
            sinks.write_parquet(report(shared).withColumn("report", F.lit(name)), f"{run}/{name}")
    return spark.read.parquet(*(f"{run}/{name}" for name in reports)).select("report", "key", "total")
