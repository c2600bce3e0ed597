"""What jobs leave on disk on their way: no shuffle files of finished writes, compressed tables."""

import glob
import os
import time

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from tidewater.operators import similarity as S
from tidewater.plans import cleaning, cleaning_q, jobs
from tidewater.session import SHUFFLE_CLEANUP_CONF, checkpointed
from tidewater.sources import sinks


def _shuffle_files(spark):
    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks()
    return {b for b in blocks.mkString(",").split(",") if b.startswith("shuffle_")}


def _left(spark, before):
    for _ in range(50):  # files go in the background
        if not (left := _shuffle_files(spark) - before):
            break
        time.sleep(0.2)
    return left


def test_writes_and_checkpoints_leave_no_shuffle_files(spark, tmp_dir):
    df = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).agg(F.count("id").alias("n"))
    was, before = spark.conf.get(SHUFFLE_CLEANUP_CONF, None), _shuffle_files(spark)
    sinks.write_parquet(df, f"{tmp_dir}/out", compression="zstd")
    kept = checkpointed(df)
    assert _left(spark, before) == set() and spark.conf.get(SHUFFLE_CLEANUP_CONF, None) == was
    assert sorted(map(tuple, kept.collect())) == sorted(map(tuple, spark.read.parquet(f"{tmp_dir}/out").collect())) == sorted(map(tuple, df.collect()))


def _tables(spark, folder):
    os.makedirs(folder)
    spark.sql("""SELECT id AS l_orderkey, id % 9 AS l_partkey, id % 3 AS l_suppkey, 1 AS l_linenumber, 2.0D AS l_quantity, 10.5D AS l_extendedprice,
        0.1D AS l_discount, TIMESTAMP_NTZ'2020-01-05' AS l_shipdate FROM range(400)""").write.parquet(f"{folder}/lineitem.parquet")
    spark.sql("SELECT id AS o_orderkey, id % 20 AS o_custkey, 'F' AS o_orderstatus, TIMESTAMP_NTZ'2020-01-02' AS o_orderdate FROM range(400)").write.parquet(f"{folder}/orders.parquet")
    spark.sql("SELECT id AS c_custkey, concat('C#', id) AS c_name, 1 AS c_nationkey, 5.0D AS c_acctbal FROM range(20)").write.parquet(f"{folder}/customer.parquet")
    spark.sql("SELECT id AS p_partkey, 'lamp' AS p_name, 'b' AS p_brand, 'home' AS p_type, 3 AS p_size, 900.0D AS p_retailprice FROM range(9)").write.parquet(f"{folder}/part.parquet")
    return folder


def test_commerce_job_keeps_little_on_disk(spark, tmp_dir):
    run = f"{tmp_dir}/run"
    paths = cleaning_q._csv_triple(spark, _tables(spark, f"{tmp_dir}/in"), run)
    parts = [f for p in paths for f in glob.glob(f"{p}/part-*")]
    assert parts and all(f.endswith(".csv.gz") for f in parts)
    before = _shuffle_files(spark)
    out = jobs.commerce_etl(spark, *paths, f"{run}/out", quarantine=True)
    assert _left(spark, before) == set()
    for name in ("raw/orders/is_bad=false", "raw/orders/is_bad=true", "clean/orders", "clean/customers", "order_details"):
        files = glob.glob(f"{run}/out/{name}/*.parquet")
        assert files and {pq.ParquetFile(f).metadata.row_group(0).column(0).compression for f in files if pq.ParquetFile(f).metadata.num_row_groups} == {"ZSTD"}, name
    counts = {r.table: r.good + r.bad for r in out["rejected"].groupBy("table").agg(F.sum("n_good").alias("good"), F.sum("n_bad").alias("bad")).collect()}
    assert counts["orders"] == sum(1 + ((k * 8 + 1) % 97 == 0) for k in range(400)) and counts["customers"] == 21


def test_order_details_join_products_first(spark):
    o = spark.createDataFrame([(1, 10, "P1", 2), (2, 11, "P1", 3), (3, 10, "P9", 4), (4, 12, "P2", 5)], "order_id int, customer_id int, product_id string, quantity int")
    c = spark.createDataFrame([(10, "Ann", True), (11, "Bo", None)], "customer_id int, first_name string, is_active boolean")
    p = spark.createDataFrame([("P1", "Lamp", False), ("P2", "Pen", True)], "product_id string, product_name string, is_active boolean")
    d = cleaning.order_details(o, c, p)
    assert d.columns == ["product_id", "customer_id", "order_id", "quantity", "first_name", "customer_is_active", "product_name", "product_is_active"]
    assert sorted(map(tuple, d.collect())) == [("P1", 10, 1, 2, "Ann", True, "Lamp", False), ("P1", 11, 2, 3, "Bo", None, "Lamp", False)]
    plan = d._jdf.queryExecution().optimizedPlan().toString()
    joins = [line for line in plan.splitlines() if "Join Inner" in line]
    assert "customer_id" in joins[0] and "product_id" in joins[1]


def test_pairs_are_planned_without_shuffle_files(spark):
    rows = [(u, u + 7 * i, 1 + (u * i) % 50) for u in range(20) for i in range(12)]
    df = spark.createDataFrame(rows, "user long, item long, rating long")
    before = _shuffle_files(spark)
    for how in ({"hot_shares": 4}, {"salt_buckets": 3}):
        got = S.item_similarity(df, **how)
        assert _left(spark, before) == set() and got.columns[:2] == ["item1", "item2"]
