"""Modelled marts as DataFrame → DataFrame functions.

These are the reusable, parameterised forms; ``plans/commerce.py`` binds them to
the driver tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.functions.columns import money, net_revenue
from tidewater.operators.aggregate import ranked_top_k


# ---- C8: dbt-style customer mart -------------------------------------------------

def stg_customers(customer: DataFrame) -> DataFrame:
    """Staging model: rename the source key to ``customer_id`` (P3), split the name."""
    return customer.select(
        F.col("c_custkey").alias("customer_id"),
        F.split_part(F.col("c_name"), F.lit("#"), F.lit(1)).alias("first_name"),
        F.split_part(F.col("c_name"), F.lit("#"), F.lit(2)).alias("last_name"),
    )


def stg_orders(orders: DataFrame) -> DataFrame:
    """Staging model for orders (P3 renames)."""
    return orders.select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").alias("order_date"),
        F.col("o_orderstatus").alias("status"),
    )


def customer_summary(customers: DataFrame, orders: DataFrame) -> DataFrame:
    """One row per customer with first/last order date and order count (0 if none).

    The per-customer aggregate is partial + final (a hot customer is pre-reduced on
    the map side); its output is already hash-partitioned by ``customer_id``, so the
    left join only shuffles the customer side.
    """
    per_customer = orders.groupBy("customer_id").agg(
        F.min("order_date").alias("first_order_date"),
        F.max("order_date").alias("most_recent_order_date"),
        F.count("order_id").alias("number_of_orders"),
    )
    return customers.join(per_customer, "customer_id", "left").select(
        "customer_id",
        "first_name",
        "last_name",
        "first_order_date",
        "most_recent_order_date",
        F.coalesce(F.col("number_of_orders"), F.lit(0)).alias("number_of_orders"),
    )


# ---- C4 / C5: denormalised order lines and the five analytics ------------------

def order_lines(lineitem: DataFrame, orders: DataFrame, customer: DataFrame, part: DataFrame) -> DataFrame:
    """C4: order lines with order, customer and part attributes (star join, J2).

    All four inputs grow with the data, so nothing is forced to broadcast; AQE turns
    a join into a broadcast at runtime only when the measured side is small.
    Clashing names are avoided by selecting only the needed, prefixed columns.
    """
    li = lineitem.select(
        "l_orderkey", "l_partkey", "l_quantity", "l_extendedprice", "l_discount", "l_linenumber"
    )
    o = orders.select("o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus")
    c = customer.select("c_custkey", "c_name", "c_mktsegment")
    p = part.select("p_partkey", "p_name", "p_brand", "p_type", "p_retailprice")
    return (
        li.join(o, li.l_orderkey == o.o_orderkey)
        .join(c, F.col("o_custkey") == F.col("c_custkey"))
        .join(p, F.col("l_partkey") == F.col("p_partkey"))
        .withColumn("net_amount", net_revenue())
    )


def revenue_by_category(lines: DataFrame) -> DataFrame:
    """Revenue and line count per category (``p_type``)."""
    return lines.groupBy(F.col("p_type").alias("category")).agg(
        F.sum("net_amount").alias("total_revenue"), F.count(F.lit(1)).alias("order_lines")
    )


def top_spenders(lines: DataFrame, k: int = 10) -> DataFrame:
    """C5 / A19 + O3: top-k customers by spend, composite group key, unique tie-break."""
    agg = lines.groupBy("c_custkey", "c_name").agg(F.sum("net_amount").alias("total_spent"))
    return ranked_top_k(agg, [F.col("total_spent").desc(), F.col("c_custkey")], k)


def profit_by_brand(lines: DataFrame) -> DataFrame:
    """``SUM((price − cost) × quantity)``; cost per unit is the part's list price."""
    profit = F.col("net_amount") - money("p_retailprice") * money("l_quantity")
    return lines.groupBy(F.col("p_brand").alias("brand")).agg(F.sum(profit).alias("total_profit"))


def monthly_sales(lines: DataFrame) -> DataFrame:
    """C5 / A21 + F23: revenue per calendar month (``date_trunc`` keeps a timestamp)."""
    month = F.date_trunc("month", F.col("o_orderdate").cast("timestamp")).cast("timestamp_ntz")
    return lines.groupBy(month.alias("month")).agg(
        F.sum("net_amount").alias("monthly_revenue"),
        F.countDistinct("l_orderkey").alias("orders"),
    )


def sales_by_category(lines: DataFrame) -> DataFrame:
    """C5 (fifth query): amount per category.  The reference labels it profit; it is revenue."""
    return lines.groupBy(F.col("p_type").alias("category")).agg(F.sum("net_amount").alias("total_amount"))


# ---- C9: small ETL ----------------------------------------------------------------

def sales_joined(orders: DataFrame, customers: DataFrame, fill_amount=25) -> DataFrame:
    """Fill → drop → dedup → join.  ``orders``: order_id, customer_id, date, amount;
    ``customers``: customer_id, city, segment."""
    from tidewater.operators.aggregate import keep_one_per_key

    o = orders.fillna({"amount": fill_amount}).dropna(subset=["customer_id"])
    o = keep_one_per_key(o, "order_id", ["customer_id", "date", "amount"])
    c = keep_one_per_key(customers, "customer_id", ["city", "segment"])
    return o.join(c, "customer_id", "inner")


def sales_etl(orders: DataFrame, customers: DataFrame, fill_amount=25) -> dict[str, DataFrame]:
    """The joined sales and three aggregates of them.

    ``sources.sinks.write_parquet(..., partition_by=["city"])`` (K2) writes ``by_city``
    partitioned by city; ``operators.layout.persisted`` keeps ``sales_joined`` for callers that
    run all three.
    """
    joined = sales_joined(orders, customers, fill_amount)
    return {
        "by_city": joined.groupBy("city").agg(
            F.sum("amount").alias("total_sales"), F.count(F.lit(1)).alias("orders")
        ),
        "avg_by_segment": joined.groupBy("segment").agg(
            (F.sum("amount").cast("double") / F.count(F.lit(1))).alias("avg_order_value")
        ),
        "top_customers": ranked_top_k(
            joined.groupBy("customer_id").agg(F.sum("amount").alias("total_spent")),
            [F.col("total_spent").desc(), F.col("customer_id")],
            3,
        ),
    }


# ---- C11: most popular / best rated items -------------------------------------

def item_stats(ratings: DataFrame, item: str, rating: str) -> DataFrame:
    """Per-item rating count and mean (mean = exact decimal sum / count, as DOUBLE)."""
    return ratings.groupBy(item).agg(
        F.count(F.lit(1)).alias("n_ratings"),
        (F.sum(money(rating)).cast("double") / F.count(F.lit(1))).alias("avg_rating"),
    )


def top_rated(ratings, names, item, rating, name_col, k=10, min_count=0):
    """C11: best mean rating (optional minimum count), names attached with default."""
    s = item_stats(ratings, item, rating).filter(F.col("n_ratings") >= min_count)
    top = ranked_top_k(s, [F.col("avg_rating").desc(), F.col(item)], k)
    return _attach_names(top, names, item, name_col)


def most_rated(ratings, names, item, rating, name_col, k=10):
    """C11: most frequently rated items with names."""
    s = item_stats(ratings, item, rating)
    top = ranked_top_k(s, [F.col("n_ratings").desc(), F.col(item)], k)
    return _attach_names(top, names, item, name_col)


def _attach_names(top: DataFrame, names: DataFrame, item: str, name_col: str) -> DataFrame:
    # The top-k side has k rows (a proven bound); the name table may be large.  Semi-join
    # the names against the broadcast k keys first, then left-join the k rows to them,
    # so the dimension is never broadcast or fully shuffled against the fact side.
    wanted = names.select(item, name_col).join(F.broadcast(top.select(item)), item, "left_semi")
    j = top.join(wanted, item, "left")
    return j.withColumn(name_col, F.coalesce(F.col(name_col), F.lit("Unknown"))).orderBy("rank")
