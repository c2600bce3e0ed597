"""File-to-file jobs: the reference's end-to-end programs re-expressed as compositions of
the library operators, taking input paths (local, HDFS or object-store URIs) and
writing Parquet outputs.  Raw schemas follow FIXTURES.md §B and are applied with
``.schema()``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.functions import text as T
from tidewater.operators import aggregate as agg
from tidewater.operators import similarity as S
from tidewater.operators.joins import anti_join
from tidewater.plans import cleaning, models
from tidewater.sources import intake, readers, sinks

# The raw files' columns and declared types.
RAW_ORDERS = (
    "order_id INT, customer_id INT, product_id STRING, order_date STRING, ship_date STRING, quantity INT, "
    "unit_price STRING, discount_pct STRING, total_amount STRING, payment_method STRING, order_status STRING"
)
RAW_PRODUCTS = (
    "product_id STRING, product_name STRING, category STRING, brand STRING, price STRING, cost STRING, "
    "stock_quantity INT, weight_kg STRING, created_date STRING, is_active STRING"
)
RAW_CUSTOMERS = (
    "customer_id INT, first_name STRING, last_name STRING, email STRING, phone STRING, signup_date STRING, "
    "country STRING, state STRING, postal_code STRING, is_active STRING, loyalty_points INT"
)


def commerce_etl(
    spark: SparkSession, orders: str, customers: str, products: str, out: str, quarantine: bool = False
) -> dict[str, DataFrame]:
    """Raw CSVs → cleaned tables (written once) → order details → five reports.

    Every output is Parquet under ``out`` (overwrite: re-runs are idempotent); the
    returned DataFrames read those files.  A field that its declared type does not take
    is NULL, as in the reference; with ``quarantine`` such rows, and rows of too few or too
    many fields, go to ``out/raw`` as raw lines instead (``rejected`` counts them per file).
    """
    raw = {"orders": (orders, RAW_ORDERS, "order_id"), "customers": (customers, RAW_CUSTOMERS, "customer_id"),
           "products": (products, RAW_PRODUCTS, "product_id")}
    counts = []
    if quarantine:
        taken = {n: intake.ingest_csv(spark, path, st, f"{out}/raw/{n}", required=(k,)) for n, (path, st, k) in raw.items()}
        raw_o, raw_c, raw_p = (taken[n].good.drop(intake.FILE, intake.FOLDER) for n in raw)
        counts = [t.counts().withColumn("table", F.lit(n)) for n, t in taken.items()]
    else:
        raw_o, raw_c, raw_p = (readers.read_csv(spark, path, st) for path, st, _ in raw.values())
    t = cleaning.publish_clean_tables(raw_o, raw_c, raw_p, f"{out}/clean")
    details = cleaning.order_details(t["orders"], t["customers"], t["products"])
    sinks.write_parquet(details, f"{out}/order_details", compression="zstd")
    d = spark.read.parquet(f"{out}/order_details")
    profit = (F.col("price") - F.col("cost")) * F.col("quantity")
    reports = {
        "revenue_by_category": d.groupBy("category").agg(
            F.sum("total_amount").alias("total_revenue"), F.count("order_id").alias("total_orders")
        ),
        "top_customers": agg.ranked_top_k(
            d.groupBy("customer_id", "first_name", "last_name").agg(F.sum("total_amount").alias("total_spent")),
            [F.col("total_spent").desc(), F.col("customer_id")], 10,
        ),
        "profit_by_product": d.groupBy("product_id", "product_name").agg(F.sum(profit).alias("total_profit")),
        "monthly_sales": d.groupBy(F.date_trunc("month", F.col("order_date")).alias("month")).agg(
            F.sum("total_amount").alias("monthly_revenue")
        ),
        "sales_by_category": d.groupBy("category").agg(F.sum("total_amount").alias("total_amount")),
    }
    out_frames = {**t, "order_details": d, **({"rejected": reduce(DataFrame.unionByName, counts)} if counts else {})}
    for name, df in reports.items():
        sinks.write_parquet(df, f"{out}/{name}")
        out_frames[name] = spark.read.parquet(f"{out}/{name}")
    return out_frames


def item_similarities(
    spark: SparkSession,
    ratings_path: str,
    items_path: str,
    item_id: int,
    out: str,
    score_threshold: float = 0.97,
    min_pairs: int = 50,
    k: int = 10,
) -> DataFrame:
    """C6 + C7 on ``user::item::rating::ts`` ratings and ``id::title::…`` items: the pair
    table is written to ``out`` (Parquet); returns the top-k partners of ``item_id``
    with titles (``Unknown`` when missing)."""
    lines = readers.read_text(spark, ratings_path)
    r = readers.parse_delimited(lines, "::", [("user", "long"), ("item", "long"), ("rating", "double"), ("ts", "long")])
    ratings = r.groupBy("user", "item").agg(F.sum(F.col("rating").cast("decimal(18,2)")).alias("rating"))
    sinks.write_parquet(S.item_similarity(ratings.checkpoint(eager=True), hot_shares=256), out)
    sims = spark.read.parquet(out)
    pick = (F.col("item1") == item_id) | (F.col("item2") == item_id)
    good = sims.filter(pick & (F.col("similarity") > score_threshold) & (F.col("num_pairs") > min_pairs)).select(
        F.when(F.col("item1") == item_id, F.col("item2")).otherwise(F.col("item1")).alias("item"),
        F.col("similarity").alias("score"),
        F.col("num_pairs").alias("strength"),
    )
    top = agg.ranked_top_k(good, [F.col("score").desc(), F.col("item")], k)
    names = readers.parse_delimited(readers.read_text(spark, items_path), "::", [("item", "long"), ("title", "string")])
    wanted = names.join(F.broadcast(top.select("item")), "item", "left_semi")
    return top.join(wanted, "item", "left").withColumn("title", F.coalesce("title", F.lit("Unknown"))).orderBy("rank")


def popular_items(spark: SparkSession, ratings_tsv: str, names_path: str, k: int = 10, min_count: int = 0):
    """C11: most-rated and best-rated items from ``user\\titem\\trating\\tts`` with
    ``id|title|…`` names in ISO-8859-1."""
    ratings = readers.read_csv(spark, ratings_tsv, "user INT, item INT, rating DOUBLE, ts LONG", header=False, sep="\t")
    names = readers.read_csv(
        spark, names_path, "item INT, title STRING", header=False, sep="|", encoding="ISO-8859-1"
    )
    return {
        "most_rated": models.most_rated(ratings, names, "item", "rating", "title", k),
        "top_rated": models.top_rated(ratings, names, "item", "rating", "title", k, min_count),
    }


def least_connected(spark: SparkSession, graph_path: str, names_path: str) -> DataFrame:
    """Nodes with the fewest connections in ``id nbr nbr …`` text, names attached."""
    lines = readers.read_text(spark, graph_path)
    deg = lines.select(*[c.alias(n) for n, c in T.neighbour_count("value").items()])
    deg = deg.groupBy("id").agg(F.sum("connections").alias("connections"))
    names = readers.read_csv(spark, names_path, "id LONG, name STRING", header=False, sep=" ")
    return agg.rows_at_minimum(deg, "connections").join(names, "id", "left")


def access_log_report(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """Hits by ip, endpoint and status from common-log-format text."""
    logs = readers.read_text(spark, path).select(*[c.alias(n) for n, c in T.access_log_fields("value").items()])
    return {k: agg.count_by(logs, k).orderBy(F.col("count").desc(), F.col(k)) for k in ("ip", "endpoint", "status")}


def word_count(spark: SparkSession, path: str, normalise: bool = True) -> DataFrame:
    """Word counts of a text file, most frequent first."""
    lines = readers.read_text(spark, path)
    tokens = T.normalised_words("value") if normalise else T.whitespace_tokens("value")
    counts = agg.count_by(lines.select(F.explode(tokens).alias("word")), "word")
    return counts.orderBy(F.col("count").desc(), F.col("word"))


def customers_without_orders(spark: SparkSession, customers_csv: str, orders_csv: str) -> DataFrame:
    """Customers (header CSV, inferred types) with no order."""
    c = readers.read_csv(spark, customers_csv, infer_schema=True)
    o = readers.read_csv(spark, orders_csv, infer_schema=True)
    return anti_join(c, o.select("customer_id"), "customer_id")
