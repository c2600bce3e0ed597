"""Source/sink round trips on data Spark derives from the driver tables.

Each query writes a derived file set into a fresh folder under the shared
checkpoint directory, reads it back through the library readers, and computes a
result the SQL oracle can compute straight from the tables.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewater.functions.columns import money
from tidewater.plans.registry import register
from tidewater.sources import intake, readers, sinks
from tidewater.sources.tables import Tables
from tidewater.streaming.events import new_run_dir


@register(
    "csv_roundtrip_segments",
    """SELECT c_mktsegment, count(*) AS customers, CAST(sum(CAST(c_acctbal AS DECIMAL(18,2))) AS DECIMAL(28,2)) AS balance
FROM customer GROUP BY c_mktsegment""",
    "S3 A2 A3",
)
def csv_roundtrip_segments(spark, sf):
    """Customers written as several header CSV files, read back by glob with a DDL schema
    (S7; types applied with ``.schema``, not ignored), then summed per segment."""
    run = new_run_dir(spark, "csv")
    c = Tables(spark, sf).customer.select("c_custkey", "c_mktsegment", money("c_acctbal").alias("c_acctbal"))
    c.write.mode("overwrite").option("header", True).csv(f"{run}/customers")
    back = readers.read_csv(
        spark, f"{run}/customers/part-*.csv", "c_custkey BIGINT, c_mktsegment STRING, c_acctbal DECIMAL(18,2)"
    )
    return back.groupBy("c_mktsegment").agg(
        F.count(F.lit(1)).alias("customers"), F.sum("c_acctbal").cast("decimal(28,2)").alias("balance")
    )


@register(
    "delimited_ratings_roundtrip",
    """SELECT p.p_brand, count(*) AS n_lines, CAST(sum(CAST(l.l_quantity AS BIGINT)) AS BIGINT) AS quantity
FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey GROUP BY p.p_brand""",
    "S1 S2 S7 S9 S10 S12 K5 J8 F3 F6",
)
def delimited_ratings_roundtrip(spark, sf):
    """``user::item::rating::ts`` text records and a ``|``-separated ISO-8859-1 item file,
    parsed back (multi-character separator, ``try_cast``) and joined."""
    run = new_run_dir(spark, "dat")
    t = Tables(spark, sf)
    t.lineitem.select(
        F.concat_ws("::", "l_orderkey", "l_partkey", F.col("l_quantity").cast("long"), "l_linenumber").alias("value")
    ).write.mode("overwrite").text(f"{run}/ratings")
    t.part.select("p_partkey", "p_brand").write.mode("overwrite").option("sep", "|").option(
        "encoding", "ISO-8859-1"
    ).csv(f"{run}/items")
    ratings = readers.parse_delimited(
        readers.read_text(spark, f"{run}/ratings"), "::",
        [("user", "long"), ("item", "long"), ("rating", "long"), ("ts", "long")],
    )
    items = readers.read_csv(
        spark, f"{run}/items", "item BIGINT, p_brand STRING", header=False, sep="|", encoding="ISO-8859-1"
    )
    j = ratings.join(items, "item")
    return j.groupBy("p_brand").agg(F.count(F.lit(1)).alias("n_lines"), F.sum("rating").alias("quantity"))


@register(
    "partitioned_orders_pruned",
    """SELECT o_orderpriority, count(*) AS n_orders, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(28,2)) AS total
FROM orders WHERE o_orderstatus = 'F' GROUP BY o_orderpriority""",
    "K1 K2 P16",
)
def partitioned_orders_pruned(spark, sf):
    """Orders written partitioned by status (K2); reading back status F scans only that
    folder (``PartitionFilters`` in the plan)."""
    run = new_run_dir(spark, "parts")
    o = Tables(spark, sf).orders.select("o_orderkey", "o_orderstatus", "o_orderpriority", money("o_totalprice").alias("p"))
    sinks.write_parquet(o, f"{run}/orders", partition_by=["o_orderstatus"])
    back = spark.read.parquet(f"{run}/orders").filter(F.col("o_orderstatus") == "F")
    return back.groupBy("o_orderpriority").agg(
        F.count(F.lit(1)).alias("n_orders"), F.sum("p").cast("decimal(28,2)").alias("total")
    )


@register(
    "dense_customer_keys",
    """SELECT c_custkey, c_name, row_number() OVER (ORDER BY c_mktsegment, c_custkey) AS number_id FROM customer""",
    "K10 O1",
)
def dense_customer_keys(spark, sf):
    """Dense 1..n surrogate keys in (segment, key) order, without a one-partition window."""
    c = Tables(spark, sf).customer.select("c_custkey", "c_name", "c_mktsegment")
    keyed = sinks.with_dense_key(c, ["c_mktsegment", "c_custkey"], "number_id")
    return keyed.select("c_custkey", "c_name", "number_id")


@register(
    "numbers_squares",
    """SELECT count(*) AS n, CAST(sum(CAST(l_linenumber AS BIGINT) * l_linenumber) AS BIGINT) AS sum_squares,
  count(*) FILTER (WHERE l_linenumber % 2 = 0) AS evens FROM lineitem""",
    "P6 P11 A12 A14",
)
def numbers_squares(spark, sf):
    """The ``map(x*x)`` / ``filter(x % 2 == 0)`` exercise over a column of
    integers (line numbers), reduced with sum and count on the executors."""
    li = Tables(spark, sf).lineitem.select(F.col("l_linenumber").cast("long").alias("value"))
    return li.agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.col("value") * F.col("value")).alias("sum_squares"),
        F.count(F.when(F.col("value") % 2 == 0, 1)).alias("evens"),
    )


@register(
    "file_name_counts",
    "SELECT 'event_type=' || event_type AS source, count(*) AS n FROM events GROUP BY event_type",
    "F28 S3",
)
def file_name_counts(spark, sf):
    """every row tagged with the file it was read from; rows per folder of those files."""
    run = new_run_dir(spark, "named")
    Tables(spark, sf).events.select("event_id", "user_id", "event_type").write.partitionBy("event_type").option("header", True).csv(f"{run}/events")
    df = readers.read_csv(spark, f"{run}/events/*/", "event_id BIGINT, user_id BIGINT", with_file_name=True)
    source = F.element_at(F.split("file_path", "/"), -2)
    return df.groupBy(source.alias("source")).agg(F.count("event_id").alias("n"))


@register(
    "csv_quarantine_by_folder",
    """WITH e AS (SELECT event_type, event_id, user_id, event_id % 11 = 0 OR event_id % 13 = 0 OR event_id % 17 = 0 OR event_id % 19 = 0 AS bad FROM events)
SELECT 'event_type=' || event_type AS folder, count(*) FILTER (WHERE NOT bad) AS n_good, count(*) FILTER (WHERE bad) AS n_bad,
  CAST(coalesce(sum(user_id) FILTER (WHERE NOT bad), 0) AS BIGINT) AS user_sum FROM e GROUP BY event_type""",
    "S16 S3 F28 K2",
)
def csv_quarantine_by_folder(spark, sf):
    """A folder of CSV files without header, one subfolder an event type, some lines of which
    lack a field, have one too many, hold text for a number or an open quote.  One scan and
    one write route good and malformed rows; both are counted per folder from the result."""
    run = new_run_dir(spark, "quarantine")
    k, ok = F.col("event_id"), F.concat_ws(",", "event_id", "user_id", "ts")
    line = (
        F.when(k % 11 == 0, F.concat_ws(",", "event_id", "user_id"))
        .when(k % 13 == 0, F.concat(ok, F.lit(",more")))
        .when(k % 17 == 0, F.concat(F.lit("no-"), ok))
        .when(k % 19 == 0, F.concat(F.lit('"'), ok))
        .otherwise(ok)
    )
    Tables(spark, sf).events.select("event_type", line.alias("value")).write.partitionBy("event_type").text(f"{run}/in")
    taken = intake.ingest_csv(spark, f"{run}/in", "event_id BIGINT, user_id BIGINT, ts TIMESTAMP_NTZ", f"{run}/out", header=False)
    sums = taken.good.groupBy(intake.FOLDER).agg(F.sum("user_id").alias("user_sum"))
    return taken.counts(intake.FOLDER).join(sums, intake.FOLDER, "left").withColumn("user_sum", F.coalesce("user_sum", F.lit(0)))


@register(
    "table_roundtrip_countries",
    """WITH c AS (SELECT c_custkey, CASE c_custkey % 5 WHEN 0 THEN 'USA' WHEN 1 THEN 'USA' WHEN 2 THEN 'USA'
                  WHEN 3 THEN 'Canada' ELSE 'Mexico' END AS country, c_acctbal FROM customer)
SELECT country, count(*) AS customers, CAST(sum(CAST(c_acctbal AS DECIMAL(18,2))) AS DECIMAL(28,2)) AS balance
FROM c GROUP BY country""",
    "K3 K4 K8 K9 S15",
)
def table_roundtrip_countries(spark, sf):
    """K4 database, K3/K8 create-or-replace table (external location in the shared
    checkpoint folder), read back by name, K9 drop."""
    import uuid

    run = new_run_dir(spark, "tables")
    db = f"tw_{uuid.uuid4().hex[:8]}"
    sinks.create_database(spark, db, location=f"{run}/db")
    c = Tables(spark, sf).customer.selectExpr(
        "c_custkey",
        "CASE c_custkey % 5 WHEN 0 THEN 'USA' WHEN 1 THEN 'USA' WHEN 2 THEN 'USA' WHEN 3 THEN 'Canada' ELSE 'Mexico' END AS country",
        "CAST(c_acctbal AS DECIMAL(18,2)) AS c_acctbal",
    )
    sinks.save_table(c, f"{db}.customers")
    back = readers.read_table(spark, f"{db}.customers")
    # Materialise the small result before the table is dropped (it lives in the shared folder).
    out = back.groupBy("country").agg(
        F.count(F.lit(1)).alias("customers"), F.sum("c_acctbal").cast("decimal(28,2)").alias("balance")
    ).checkpoint(eager=True)
    sinks.drop_table(spark, f"{db}.customers")
    spark.sql(f"DROP DATABASE IF EXISTS {db}")
    return out
