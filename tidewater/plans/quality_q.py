"""Data-quality queries (Q1–Q4, K13-style model tests) on the staging models of C8."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewater.operators import quality as Q
from tidewater.plans import models
from tidewater.plans.registry import register
from tidewater.sources.tables import Tables

# Order states accepted by the order-status test of the staging model,
# mapped onto this data's status codes (F = finished, O = open); P (pending) fails.
ACCEPTED_STATUS = ["F", "O"]


def _models(spark, sf):
    t = Tables(spark, sf)
    return models.stg_customers(t.customer), models.stg_orders(t.orders), t


@register(
    "quality_unique_nation",
    "SELECT c_nationkey, count(*) AS n_records FROM customer WHERE c_nationkey IS NOT NULL GROUP BY c_nationkey HAVING count(*) > 1",
    "Q1",
)
def quality_unique_nation(spark, sf):
    """Q1 with failures: nation keys are not unique among customers."""
    return Q.unique(Tables(spark, sf).customer, "c_nationkey")


@register(
    "quality_accepted_status",
    "SELECT o_orderkey AS order_id, o_orderstatus AS status FROM orders WHERE o_orderstatus IS NOT NULL AND o_orderstatus NOT IN ('F', 'O')",
    "Q3",
)
def quality_accepted_status(spark, sf):
    _, o, _ = _models(spark, sf)
    return Q.accepted_values(o, "status", ACCEPTED_STATUS).select("order_id", "status")


@register(
    "quality_relationships",
    """SELECT o.o_orderkey AS order_id, o.o_custkey AS customer_id FROM orders o
WHERE o.o_custkey IS NOT NULL AND NOT EXISTS (
  SELECT 1 FROM customer c WHERE c.c_custkey = o.o_custkey AND c.c_mktsegment <> 'MACHINERY')""",
    "Q4",
)
def quality_relationships(spark, sf):
    """Q4 with failures: orders whose customer is missing from a (segment-filtered) parent."""
    c, o, t = _models(spark, sf)
    parent = t.customer.filter(F.col("c_mktsegment") != "MACHINERY").select(F.col("c_custkey").alias("customer_id"))
    return Q.relationships(o, "customer_id", parent, "customer_id").select("order_id", "customer_id")


@register(
    "quality_report",
    """SELECT model, "column", test, CAST(failures AS BIGINT) AS failures,
  CASE WHEN failures = 0 THEN 'pass' ELSE 'fail' END AS status FROM (VALUES
  ('stg_customers', 'customer_id', 'unique', (SELECT count(*) FROM (SELECT c_custkey FROM customer WHERE c_custkey IS NOT NULL GROUP BY 1 HAVING count(*) > 1))),
  ('stg_customers', 'customer_id', 'not_null', (SELECT count(*) FROM customer WHERE c_custkey IS NULL)),
  ('stg_orders', 'order_id', 'unique', (SELECT count(*) FROM (SELECT o_orderkey FROM orders WHERE o_orderkey IS NOT NULL GROUP BY 1 HAVING count(*) > 1))),
  ('stg_orders', 'order_id', 'not_null', (SELECT count(*) FROM orders WHERE o_orderkey IS NULL)),
  ('stg_orders', 'status', 'accepted_values', (SELECT count(*) FROM orders WHERE o_orderstatus IS NOT NULL AND o_orderstatus NOT IN ('F', 'O'))),
  ('stg_orders', 'customer_id', 'not_null', (SELECT count(*) FROM orders WHERE o_custkey IS NULL)),
  ('stg_orders', 'customer_id', 'relationships', (SELECT count(*) FROM orders o WHERE o_custkey IS NOT NULL
      AND NOT EXISTS (SELECT 1 FROM customer c WHERE c.c_custkey = o.o_custkey))),
  ('customers', 'customer_id', 'unique', (SELECT count(*) FROM (SELECT c_custkey FROM customer WHERE c_custkey IS NOT NULL GROUP BY 1 HAVING count(*) > 1))),
  ('customers', 'customer_id', 'not_null', (SELECT count(*) FROM customer WHERE c_custkey IS NULL))
) AS t(model, "column", test, failures)""",
    "Q1 Q2 Q3 Q4 C8",
)
def quality_report(spark, sf):
    """The model tests of the staging and mart models, one summary row per test, each model scanned once.

    The mart is written first, as the table that the tests of a built model read."""
    c, o, _ = _models(spark, sf)
    mart = models.customer_summary(c, o).select("customer_id").checkpoint(eager=True)
    return Q.run_suite(
        [
            Q.Model("stg_customers", c, unique=["customer_id"], not_null=["customer_id"]),
            Q.Model(
                "stg_orders", o, unique=["order_id"], not_null=["order_id", "customer_id"], accepted={"status": ACCEPTED_STATUS},
                relationships=[("customer_id", "stg_customers", "customer_id")],
            ),
            Q.Model("customers", mart, unique=["customer_id"], not_null=["customer_id"]),
        ]
    )
