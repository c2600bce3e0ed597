"""Commerce queries over the driver tables: C4, C5, C8, C11, J2–J10.

Each builder returns a lazy DataFrame; the SQL beside it is the independent
DuckDB oracle over the same Parquet tables.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewater.functions.columns import money, net_revenue
from tidewater.operators import aggregate as agg
from tidewater.operators.joins import anti_join, lookup, salted_join
from tidewater.plans import models
from tidewater.plans.registry import register
from tidewater.sources.sinks import register_view
from tidewater.sources.tables import Tables

NET = "CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(18,2)))"

_LINES_SQL = f"""
  SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_quantity, o.o_orderdate, o.o_orderstatus,
         c.c_custkey, c.c_name, c.c_mktsegment, p.p_name, p.p_brand, p.p_type, p.p_retailprice,
         {NET} AS net_amount
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
       JOIN customer c ON o.o_custkey = c.c_custkey
       JOIN part p ON l.l_partkey = p.p_partkey"""


def _lines(spark, sf):
    t = Tables(spark, sf)
    return models.order_lines(t.lineitem, t.orders, t.customer, t.part)


@register(
    "customer_summary",
    """
WITH customers AS (
  SELECT c_custkey AS customer_id, split_part(c_name, '#', 1) AS first_name,
         split_part(c_name, '#', 2) AS last_name FROM customer),
stg_orders AS (
  SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderdate AS order_date FROM orders),
customer_orders AS (
  SELECT customer_id, min(order_date) AS first_order_date, max(order_date) AS most_recent_order_date,
         count(order_id) AS number_of_orders
  FROM stg_orders GROUP BY 1)
SELECT customers.customer_id, first_name, last_name, first_order_date, most_recent_order_date,
       coalesce(number_of_orders, 0) AS number_of_orders
FROM customers LEFT JOIN customer_orders USING (customer_id)
""",
    "C8 S15 P3 P26 A7 J4 F18",
)
def customer_summary(spark, sf):
    t = Tables(spark, sf)
    return models.customer_summary(models.stg_customers(t.customer), models.stg_orders(t.orders))


@register(
    "order_details",
    f"""SELECT l_orderkey, l_linenumber, o_orderdate, o_orderstatus, c_name, c_mktsegment,
       p_name, p_brand, p_type, l_quantity, CAST(net_amount AS DECIMAL(38,4)) AS net_amount FROM ({_LINES_SQL}) x""",
    "C4 J1 J2 A27",
)
def order_details(spark, sf):
    return _lines(spark, sf).select(
        "l_orderkey", "l_linenumber", "o_orderdate", "o_orderstatus", "c_name", "c_mktsegment",
        "p_name", "p_brand", "p_type", "l_quantity", "net_amount",
    )


@register(
    "revenue_by_category",
    f"""SELECT p_type AS category, sum(net_amount) AS total_revenue, count(*) AS order_lines
FROM ({_LINES_SQL}) x GROUP BY p_type""",
    "C5 A18 A2",
)
def revenue_by_category(spark, sf):
    return models.revenue_by_category(_lines(spark, sf))


@register(
    "top_spenders",
    f"""SELECT c_custkey, c_name, sum(net_amount) AS total_spent,
  CAST(row_number() OVER (ORDER BY sum(net_amount) DESC, c_custkey) AS INTEGER) AS rank FROM ({_LINES_SQL}) x
GROUP BY c_custkey, c_name ORDER BY total_spent DESC, c_custkey LIMIT 10""",
    "C5 A19 O3",
)
def top_spenders(spark, sf):
    return models.top_spenders(_lines(spark, sf), 10)


@register(
    "profit_by_brand",
    f"""SELECT p_brand AS brand,
  sum(net_amount - CAST(p_retailprice AS DECIMAL(18,2)) * CAST(l_quantity AS DECIMAL(18,2))) AS total_profit
FROM ({_LINES_SQL}) x GROUP BY p_brand""",
    "C5 A20 F9",
)
def profit_by_brand(spark, sf):
    return models.profit_by_brand(_lines(spark, sf))


@register(
    "monthly_sales",
    f"""SELECT date_trunc('month', o_orderdate) AS month, sum(net_amount) AS monthly_revenue,
  count(DISTINCT l_orderkey) AS orders FROM ({_LINES_SQL}) x GROUP BY 1""",
    "C5 A21 F23",
)
def monthly_sales(spark, sf):
    return models.monthly_sales(_lines(spark, sf))


@register(
    "sales_by_category",
    f"""SELECT p_type AS category, sum(net_amount) AS total_amount FROM ({_LINES_SQL}) x GROUP BY p_type""",
    "C5 A18",
)
def sales_by_category(spark, sf):
    return models.sales_by_category(_lines(spark, sf))


_RATING_AVG = "CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) / count(*)"


@register(
    "top_rated_items",
    f"""WITH s AS (SELECT l_partkey, count(*) AS n_ratings, {_RATING_AVG} AS avg_rating
             FROM lineitem GROUP BY l_partkey ORDER BY avg_rating DESC, l_partkey LIMIT 10)
SELECT s.l_partkey, s.n_ratings, s.avg_rating, coalesce(p.p_name, 'Unknown') AS p_name,
  CAST(row_number() OVER (ORDER BY s.avg_rating DESC, s.l_partkey) AS INTEGER) AS rank
FROM s LEFT JOIN part p ON s.l_partkey = p.p_partkey ORDER BY rank""",
    "C11 A6 O1 O3 J8",
)
def top_rated_items(spark, sf):
    t = Tables(spark, sf)
    names = t.part.select(F.col("p_partkey").alias("l_partkey"), "p_name")
    return models.top_rated(t.lineitem, names, "l_partkey", "l_quantity", "p_name", k=10)


@register(
    "most_rated_items",
    f"""WITH s AS (SELECT l_partkey, count(*) AS n_ratings, {_RATING_AVG} AS avg_rating
             FROM lineitem GROUP BY l_partkey ORDER BY n_ratings DESC, l_partkey LIMIT 10)
SELECT s.l_partkey, s.n_ratings, s.avg_rating, coalesce(p.p_name, 'Unknown') AS p_name,
  CAST(row_number() OVER (ORDER BY s.n_ratings DESC, s.l_partkey) AS INTEGER) AS rank
FROM s LEFT JOIN part p ON s.l_partkey = p.p_partkey ORDER BY rank""",
    "C11 A1 O2 O3 J8",
)
def most_rated_items(spark, sf):
    t = Tables(spark, sf)
    names = t.part.select(F.col("p_partkey").alias("l_partkey"), "p_name")
    return models.most_rated(t.lineitem, names, "l_partkey", "l_quantity", "p_name", k=10)


@register(
    "revenue_by_region",
    f"""SELECT r.r_name, sum({NET}) AS revenue, count(*) AS order_lines
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
JOIN customer c ON o.o_custkey = c.c_custkey
JOIN nation n ON c.c_nationkey = n.n_nationkey
JOIN region r ON n.n_regionkey = r.r_regionkey GROUP BY r.r_name""",
    "J2 J9 A2",
)
def revenue_by_region(spark, sf):
    """J2 star join; Spark broadcasts nation and region by its own size estimates."""
    t = Tables(spark, sf)
    geo = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    li = t.lineitem.select("l_orderkey", net_revenue().alias("net"))
    o = t.orders.select("o_orderkey", "o_custkey")
    c = t.customer.select("c_custkey", "c_nationkey")
    j = (
        li.join(o, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(c, F.col("o_custkey") == F.col("c_custkey"))
        .join(geo, F.col("c_nationkey") == F.col("n_nationkey"))
    )
    return j.groupBy("r_name").agg(F.sum("net").alias("revenue"), F.count(F.lit(1)).alias("order_lines"))


@register(
    "customers_per_nation",
    """SELECT n.n_name, count(*) AS customers FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
GROUP BY n.n_name""",
    "J9 A1",
)
def customers_per_nation(spark, sf):
    """``df.join(df2, "id").groupBy("city").count()`` ; Spark broadcasts the side
    that its size estimates show to be small.  The plan is then scan → BroadcastHashJoin → partial HashAggregate → one shuffle of
    at most (#nations × #tasks) rows; the large side is never shuffled by key.
    """
    t = Tables(spark, sf)
    c = t.customer.select("c_nationkey")
    n = t.nation.select("n_nationkey", "n_name")
    return c.join(n, F.col("c_nationkey") == F.col("n_nationkey")).groupBy("n_name").agg(
        F.count(F.lit(1)).alias("customers")
    )


@register(
    "part_lookup_unknown",
    """SELECT l.l_partkey, coalesce(p.p_name, 'Unknown') AS p_name, count(*) AS n_lines
FROM lineitem l LEFT JOIN (SELECT p_partkey, p_name FROM part WHERE p_size <= 40) p
  ON l.l_partkey = p.p_partkey GROUP BY l.l_partkey, coalesce(p.p_name, 'Unknown')""",
    "J8 U1 A1",
)
def part_lookup_unknown(spark, sf):
    """Per-part line counts with names, ``Unknown`` for parts missing from the (filtered) dimension.

    The count is aggregated before the lookup, so the join sees one row per part.
    """
    t = Tables(spark, sf)
    counts = agg.count_by(t.lineitem, "l_partkey", "n_lines")
    dim = t.part.filter(F.col("p_size") <= 40).select(F.col("p_partkey").alias("l_partkey"), "p_name")
    return lookup(counts, dim, "l_partkey", ["p_name"]).select("l_partkey", "p_name", "n_lines")


@register(
    "orders_by_segment_left",
    """SELECT coalesce(c.c_mktsegment, 'Unknown') AS segment, count(*) AS n_orders,
       count(c.c_custkey) AS matched_orders
FROM orders o LEFT JOIN (SELECT c_custkey, c_mktsegment FROM customer WHERE c_mktsegment <> 'HOUSEHOLD') c
  ON o.o_custkey = c.c_custkey GROUP BY 1""",
    "J3 J4 F18 A1",
)
def orders_by_segment_left(spark, sf):
    t = Tables(spark, sf)
    c = t.customer.filter(F.col("c_mktsegment") != "HOUSEHOLD").select("c_custkey", "c_mktsegment")
    j = t.orders.select("o_custkey").join(c, F.col("o_custkey") == F.col("c_custkey"), "left")
    return j.groupBy(F.coalesce(F.col("c_mktsegment"), F.lit("Unknown")).alias("segment")).agg(
        F.count(F.lit(1)).alias("n_orders"), F.count("c_custkey").alias("matched_orders")
    )


@register(
    "customers_without_orders",
    """SELECT c.c_custkey, c.c_name FROM customer c
WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND o.o_orderstatus = 'P')""",
    "J5 P16",
)
def customers_without_orders(spark, sf):
    t = Tables(spark, sf)
    pending = t.orders.filter(F.col("o_orderstatus") == "P").select("o_custkey")
    return anti_join(
        t.customer.select("c_custkey", "c_name"), pending, F.col("c_custkey") == F.col("o_custkey")
    )


@register(
    "customers_without_urgent_orders_sql",
    """SELECT c.c_custkey, c.c_name FROM customer c LEFT JOIN
  (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT' AND o_orderstatus = 'F') o
  ON c.c_custkey = o.o_custkey WHERE o.o_custkey IS NULL""",
    "J6 K7 P13 P18",
)
def customers_without_urgent_orders_sql(spark, sf):
    """J6 through SQL text over temp views; written as LEFT ANTI JOIN (Catalyst does not
    rewrite ``LEFT JOIN … IS NULL`` into an anti join)."""
    t = Tables(spark, sf)
    customer, orders = register_view(t.customer), register_view(t.orders)
    return spark.sql(
        f"""SELECT c.c_custkey, c.c_name FROM {customer} c LEFT ANTI JOIN
           (SELECT o_custkey FROM {orders} WHERE o_orderpriority = '1-URGENT' AND o_orderstatus = 'F') o
           ON c.c_custkey = o.o_custkey"""
    )


@register(
    "salted_count",
    f"""SELECT l_returnflag, count(*) AS row_count, sum({NET}) AS total FROM lineitem GROUP BY l_returnflag""",
    "J10 A2 A1",
)
def salted_count(spark, sf):
    """Hot-key aggregate (three return flags hold all rows) in two salted phases."""
    t = Tables(spark, sf)
    li = t.lineitem.select("l_orderkey", "l_linenumber", "l_returnflag", "l_extendedprice", "l_discount")
    return agg.salted_sum_count(li, "l_returnflag", net_revenue(), 32, ["l_orderkey", "l_linenumber"])


@register(
    "salted_join_brand",
    f"""SELECT p.p_brand, count(*) AS order_lines, sum({NET}) AS revenue
FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey GROUP BY p.p_brand""",
    "J10 J1",
)
def salted_join_brand(spark, sf):
    """J10 join half: hot parts are looked for, and none found here, so nothing is repeated."""
    t = Tables(spark, sf)
    li = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "l_discount")
    p = t.part.select(F.col("p_partkey").alias("l_partkey"), "p_brand")
    j = salted_join(li, p, "l_partkey", 8, ["l_orderkey", "l_linenumber"])
    return j.groupBy("p_brand").agg(F.count(F.lit(1)).alias("order_lines"), F.sum(net_revenue()).alias("revenue"))


@register(
    "salted_join_hot_part",
    f"""WITH h AS (SELECT CASE WHEN l_orderkey % 3 = 0 THEN 1 WHEN l_orderkey % 50 = 1 THEN NULL ELSE l_partkey END AS l_partkey, l_extendedprice, l_discount FROM lineitem)
SELECT coalesce(p.p_brand, 'none') AS p_brand, count(*) AS order_lines, sum({NET}) AS revenue
FROM h LEFT JOIN part p ON h.l_partkey = p.p_partkey GROUP BY 1""",
    "J10 J3",
)
def salted_join_hot_part(spark, sf):
    """J10 where one part has a third of all lines and some lines have none: the part is found by a sketch
    and split; no other part is repeated."""
    t = Tables(spark, sf)
    part = F.when(F.col("l_orderkey") % 3 == 0, F.lit(1)).when(F.col("l_orderkey") % 50 != 1, F.col("l_partkey"))
    li = t.lineitem.select("l_orderkey", "l_linenumber", part.cast("long").alias("l_partkey"), "l_extendedprice", "l_discount")
    p = t.part.select(F.col("p_partkey").alias("l_partkey"), "p_brand")
    j = salted_join(li, p, "l_partkey", 16, ["l_orderkey", "l_linenumber"], how="left")
    brand = F.coalesce("p_brand", F.lit("none")).alias("p_brand")
    return j.groupBy(brand).agg(F.count(F.lit(1)).alias("order_lines"), F.sum(net_revenue()).alias("revenue"))


@register(
    "etl_sales_by_city",
    """WITH o AS (SELECT o_orderkey AS order_id, o_custkey AS customer_id,
                     CAST(o_totalprice AS DECIMAL(18,2)) AS amount FROM orders),
c AS (SELECT c.c_custkey AS customer_id, n.n_name AS city FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey)
SELECT city, CAST(sum(amount) AS DECIMAL(28,2)) AS total_sales, count(*) AS orders FROM o JOIN c USING (customer_id) GROUP BY city""",
    "C9 A26 P19 P20 A16",
)
def etl_sales_by_city(spark, sf):
    return _etl(spark, sf)["by_city"]


@register(
    "etl_avg_by_segment",
    """WITH o AS (SELECT o_orderkey AS order_id, o_custkey AS customer_id,
                     CAST(o_totalprice AS DECIMAL(18,2)) AS amount FROM orders),
c AS (SELECT c_custkey AS customer_id, c_mktsegment AS segment FROM customer)
SELECT segment, CAST(sum(amount) AS DOUBLE) / count(*) AS avg_order_value FROM o JOIN c USING (customer_id) GROUP BY segment""",
    "C9 A6",
)
def etl_avg_by_segment(spark, sf):
    return _etl(spark, sf)["avg_by_segment"]


@register(
    "etl_top_customers",
    """SELECT o_custkey AS customer_id, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(28,2)) AS total_spent,
  CAST(row_number() OVER (ORDER BY sum(CAST(o_totalprice AS DECIMAL(18,2))) DESC, o_custkey) AS INTEGER) AS rank
FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY o_custkey ORDER BY total_spent DESC, customer_id LIMIT 3""",
    "C9 O3",
)
def etl_top_customers(spark, sf):
    return _etl(spark, sf)["top_customers"]


def _etl_inputs(spark, sf):
    t = Tables(spark, sf)
    orders = t.orders.select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").alias("date"),
        money("o_totalprice").alias("amount"),
    )
    nation = t.nation.select("n_nationkey", "n_name")
    customers = t.customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("c_custkey").alias("customer_id"), F.col("n_name").alias("city"), F.col("c_mktsegment").alias("segment")
    )
    return orders, customers


def _etl(spark, sf):
    return models.sales_etl(*_etl_inputs(spark, sf))


def etl_sales(spark, sf):
    """The joined sales of C9, for several reports at once."""
    return models.sales_joined(*_etl_inputs(spark, sf))


@register(
    "largest_smallest_orders",
    """(SELECT 'largest' AS side, o_orderkey, CAST(o_totalprice AS DECIMAL(18,2)) AS amount FROM orders
    ORDER BY o_totalprice DESC, o_orderkey LIMIT 5)
UNION ALL
(SELECT 'smallest' AS side, o_orderkey, CAST(o_totalprice AS DECIMAL(18,2)) AS amount FROM orders
    ORDER BY o_totalprice, o_orderkey LIMIT 5)
UNION ALL
(SELECT 'first' AS side, o_orderkey, CAST(o_totalprice AS DECIMAL(18,2)) AS amount FROM orders
    ORDER BY o_orderkey LIMIT 3)""",
    "O4 O5 O7 O2",
)
def largest_smallest_orders(spark, sf):
    """The n largest and smallest orders and the first 3 by key — each a
    ``TakeOrderedAndProject`` (per-task top-n, then a merge of n × tasks rows)."""
    o = Tables(spark, sf).orders.select("o_orderkey", money("o_totalprice").alias("amount"))
    big = agg.top_k(o, [F.col("amount").desc(), F.col("o_orderkey")], 5).withColumn("side", F.lit("largest"))
    small = agg.top_k(o, [F.col("amount"), F.col("o_orderkey")], 5).withColumn("side", F.lit("smallest"))
    first = agg.top_k(o, [F.col("o_orderkey")], 3).withColumn("side", F.lit("first"))
    return big.unionByName(small).unionByName(first).select("side", "o_orderkey", "amount")
