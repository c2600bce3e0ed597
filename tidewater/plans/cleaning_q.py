"""Cleaning queries (C1–C4 + a C5 report on the cleaned tables).

The raw inputs are the reference's raw-CSV shapes (all text except declared
integers), rendered from the driver tables by Spark with a deterministic CASE on
each row's key, so every dirty case of FIXTURES.md §B occurs and the work grows
with the tables.  The DuckDB oracle renders the same raw rows with the same rules
and cleans them in SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.plans import cleaning
from tidewater.plans.registry import register
from tidewater.session import shuffles_dropped
from tidewater.sources.tables import Tables

# ---- raw renderers (Spark) ------------------------------------------------------------


def _copies(condition: str):
    """0 for every row, plus a second copy (1) where ``condition`` holds: the raw feed
    repeats some ids with one changed field.  One scan, no union."""
    return F.explode(F.expr(f"CASE WHEN {condition} THEN array(0, 1) ELSE array(0) END")).alias("copy")


def raw_orders(lineitem: DataFrame, orders: DataFrame) -> DataFrame:
    j = lineitem.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("k"),
        _copies("(l_orderkey * 8 + l_linenumber) % 97 = 0"),
        "o_custkey", "l_partkey", "l_quantity", "l_extendedprice", "l_discount", "o_orderstatus",
        F.col("o_orderdate").cast("date").alias("od"), F.col("l_shipdate").cast("date").alias("sd"),
    )
    base = j.selectExpr(
        "copy",
        "k AS order_id",
        "o_custkey AS customer_id",
        "CASE WHEN k % 40 = 0 THEN concat('X', l_partkey) WHEN k % 71 = 0 THEN 'null' ELSE concat('P', l_partkey) END AS product_id",
        """CASE WHEN k % 61 = 0 THEN '2024-02-30' WHEN k % 67 = 0 THEN ' '
                WHEN k % 5 = 0 THEN date_format(od, 'yyyy/MM/dd') WHEN k % 5 = 1 THEN date_format(od, 'MM-dd-yyyy')
                WHEN k % 5 = 2 THEN concat('  ', date_format(od, 'yyyy-MM-dd'), ' ')
                ELSE date_format(od, 'yyyy-MM-dd') END AS order_date""",
        """CASE WHEN k % 23 = 0 THEN date_format(date_sub(od, 3), 'yyyy-MM-dd') WHEN k % 29 = 0 THEN 'N/A'
                ELSE date_format(sd, 'yyyy-MM-dd') END AS ship_date""",
        "CASE WHEN k % 31 = 0 THEN 0 ELSE CAST(l_quantity AS INT) END + copy AS quantity",
        """CASE WHEN k % 37 = 0 THEN 'abc' WHEN k % 41 = 0 THEN 'NULL'
                WHEN k % 3 = 0 THEN concat('$', CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS STRING))
                WHEN k % 7 = 0 THEN concat(CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS STRING), '5')
                ELSE CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS STRING) END AS unit_price""",
        """CASE WHEN k % 43 = 0 THEN '150' WHEN k % 47 = 0 THEN NULL WHEN k % 11 = 0 THEN '12.345'
                ELSE CAST(CAST(CAST(l_discount AS DECIMAL(18,2)) * 100 AS INT) AS STRING) END AS discount_pct""",
        """CASE WHEN k % 53 = 0 THEN '1,299.99'
                ELSE concat('$', CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS STRING)) END AS total_amount""",
        "CASE k % 4 WHEN 0 THEN 'Visa' WHEN 1 THEN 'MasterCard' WHEN 2 THEN 'Debit' ELSE 'PayPal' END AS payment_method",
        """CASE WHEN k % 19 = 0 THEN 'Unknown' WHEN k % 13 = 0 THEN ' delivered '
                WHEN o_orderstatus = 'F' THEN 'Delivered' WHEN o_orderstatus = 'O' THEN 'Shipped' ELSE 'Pending' END AS order_status""",
    )
    return base.drop("copy")


def raw_customers(customer: DataFrame) -> DataFrame:
    base = customer.select("*", _copies("c_custkey % 89 = 0")).selectExpr(
        "c_custkey AS customer_id",
        """CASE WHEN c_custkey % 17 = 0 THEN '  ' WHEN c_custkey % 11 = 0 THEN concat(' ', split_part(c_name, '#', 1), ' ')
                ELSE split_part(c_name, '#', 1) END AS first_name""",
        "split_part(c_name, '#', 2) AS last_name",
        """CASE WHEN c_custkey % 13 = 0 THEN concat('cust', c_custkey, '@bad')
                WHEN c_custkey % 7 = 0 THEN concat('CUST', c_custkey, '@EXAMPLE.COM')
                ELSE concat('cust', c_custkey, '@example.com') END AS email""",
        """CASE WHEN c_custkey % 9 = 0 THEN '555-1234' WHEN c_custkey % 10 = 0 THEN '1234567890123456'
                ELSE concat('+1 (', lpad(CAST(c_nationkey + 100 AS STRING), 3, '0'), ') ',
                            substr(lpad(CAST(c_custkey AS STRING), 7, '0'), 1, 3), '-',
                            substr(lpad(CAST(c_custkey AS STRING), 7, '0'), 4, 4)) END AS phone""",
        """CASE WHEN c_custkey % 53 = 0 THEN '2024-02-30'
                WHEN c_custkey % 4 = 0 THEN date_format(date_add(DATE'2020-01-01', CAST(c_custkey % 1000 AS INT)), 'yyyy/MM/dd')
                WHEN c_custkey % 4 = 1 THEN date_format(date_add(DATE'2020-01-01', CAST(c_custkey % 1000 AS INT)), 'MM-dd-yyyy')
                ELSE date_format(date_add(DATE'2020-01-01', CAST(c_custkey % 1000 AS INT)), 'yyyy-MM-dd') END AS signup_date""",
        """CASE c_custkey % 5 WHEN 0 THEN 'USA' WHEN 1 THEN 'U.S.A.' WHEN 2 THEN 'united states'
                WHEN 3 THEN 'canada' ELSE 'Mexico' END AS country""",
        "CASE c_custkey % 4 WHEN 0 THEN 'mn' WHEN 1 THEN 'Minnesota' WHEN 2 THEN ' ca ' ELSE NULL END AS state",
        "lpad(CAST(c_custkey % 100000 AS STRING), 5, '0') AS postal_code",
        """CASE c_custkey % 6 WHEN 0 THEN 'yes' WHEN 1 THEN 'N' WHEN 2 THEN 'TRUE' WHEN 3 THEN 'false'
                WHEN 4 THEN 'maybe' ELSE 'Y' END AS is_active""",
        """CASE WHEN c_custkey % 8 = 0 THEN NULL WHEN c_custkey % 8 = 1 THEN -5
                ELSE CAST(floor(c_acctbal) AS INT) END + copy AS loyalty_points""",
    )
    return base


def raw_products(part: DataFrame) -> DataFrame:
    p = part.withColumn("pr", F.col("p_retailprice").cast("decimal(18,2)")).select(
        "*", _copies("p_partkey % 83 = 0")
    )
    base = p.selectExpr(
        "CASE WHEN p_partkey % 29 = 0 THEN concat('X', p_partkey) ELSE concat('P', p_partkey) END AS product_id",
        "p_name AS product_name",
        "p_type AS category",
        "CASE WHEN p_partkey % 19 = 0 THEN '' ELSE lower(p_brand) END AS brand",
        """CASE WHEN p_partkey % 37 = 0 THEN 'abc' WHEN p_partkey % 31 = 0 THEN '1,299.99'
                WHEN p_partkey % 7 = 0 THEN replace(CAST(pr AS STRING), '.', ',')
                WHEN p_partkey % 3 = 0 THEN concat('$', CAST(pr AS STRING))
                WHEN p_partkey % 5 = 0 THEN concat(CAST(pr AS STRING), '5') ELSE CAST(pr AS STRING) END AS price""",
        """CASE WHEN p_partkey % 41 = 0 THEN '-5.00' WHEN p_partkey % 11 = 0 THEN concat('$', CAST(pr - 100 AS STRING))
                ELSE CAST(pr - 100 AS STRING) END AS cost""",
        "CASE WHEN p_partkey % 13 = 0 THEN NULL ELSE p_size * 10 - 50 END + copy AS stock_quantity",
        "CASE WHEN p_partkey % 43 = 0 THEN 'heavy' WHEN p_partkey % 4 = 0 THEN concat(CAST(p_size AS STRING), '.125') ELSE concat(CAST(p_size AS STRING), '.5') END AS weight_kg",
        """CASE WHEN p_partkey % 47 = 0 THEN '13-45-2020'
                WHEN p_partkey % 3 = 0 THEN date_format(date_add(DATE'2019-01-01', CAST(p_partkey % 1500 AS INT)), 'MM-dd-yyyy')
                WHEN p_partkey % 3 = 1 THEN date_format(date_add(DATE'2019-01-01', CAST(p_partkey % 1500 AS INT)), 'yyyy/MM/dd')
                ELSE date_format(date_add(DATE'2019-01-01', CAST(p_partkey % 1500 AS INT)), 'yyyy-MM-dd') END AS created_date""",
        "CASE p_partkey % 5 WHEN 0 THEN 'Yes' WHEN 1 THEN 'no' WHEN 2 THEN ' y ' WHEN 3 THEN 'FALSE' ELSE 'maybe' END AS is_active",
    )
    return base


# ---- DuckDB renderers + cleaning (oracle) ---------------------------------------------

_RAW_ORDERS_SQL = """
j AS (SELECT l_orderkey * 8 + l_linenumber AS k, o_custkey, l_partkey, l_quantity, l_extendedprice, l_discount,
             o_orderstatus, CAST(o_orderdate AS DATE) AS od, CAST(l_shipdate AS DATE) AS sd
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
base_o AS (SELECT k AS order_id, o_custkey AS customer_id,
  CASE WHEN k % 40 = 0 THEN 'X' || CAST(l_partkey AS VARCHAR) WHEN k % 71 = 0 THEN 'null' ELSE 'P' || CAST(l_partkey AS VARCHAR) END AS product_id,
  CASE WHEN k % 61 = 0 THEN '2024-02-30' WHEN k % 67 = 0 THEN ' '
       WHEN k % 5 = 0 THEN strftime(od, '%Y/%m/%d') WHEN k % 5 = 1 THEN strftime(od, '%m-%d-%Y')
       WHEN k % 5 = 2 THEN '  ' || strftime(od, '%Y-%m-%d') || ' ' ELSE strftime(od, '%Y-%m-%d') END AS order_date,
  CASE WHEN k % 23 = 0 THEN strftime(od - 3, '%Y-%m-%d') WHEN k % 29 = 0 THEN 'N/A' ELSE strftime(sd, '%Y-%m-%d') END AS ship_date,
  CASE WHEN k % 31 = 0 THEN 0 ELSE CAST(l_quantity AS INTEGER) END AS quantity,
  CASE WHEN k % 37 = 0 THEN 'abc' WHEN k % 41 = 0 THEN 'NULL'
       WHEN k % 3 = 0 THEN '$' || CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR)
       WHEN k % 7 = 0 THEN CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR) || '5'
       ELSE CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR) END AS unit_price,
  CASE WHEN k % 43 = 0 THEN '150' WHEN k % 47 = 0 THEN NULL WHEN k % 11 = 0 THEN '12.345'
       ELSE CAST(CAST(CAST(l_discount AS DECIMAL(18,2)) * 100 AS INTEGER) AS VARCHAR) END AS discount_pct,
  CASE WHEN k % 53 = 0 THEN '1,299.99' ELSE '$' || CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR) END AS total_amount,
  CASE k % 4 WHEN 0 THEN 'Visa' WHEN 1 THEN 'MasterCard' WHEN 2 THEN 'Debit' ELSE 'PayPal' END AS payment_method,
  CASE WHEN k % 19 = 0 THEN 'Unknown' WHEN k % 13 = 0 THEN ' delivered '
       WHEN o_orderstatus = 'F' THEN 'Delivered' WHEN o_orderstatus = 'O' THEN 'Shipped' ELSE 'Pending' END AS order_status
  FROM j),
raw_o AS (SELECT * FROM base_o UNION ALL SELECT * REPLACE (quantity + 1 AS quantity) FROM base_o WHERE order_id % 97 = 0)"""

_DATE = """coalesce(CAST(try_strptime({c}, '%Y-%m-%d') AS DATE), CAST(try_strptime({c}, '%Y/%m/%d') AS DATE),
                   CAST(try_strptime({c}, '%m-%d-%Y') AS DATE))"""


def _tidy(c, tokens=False):
    t = f"CASE WHEN trim({c}) = '' THEN NULL ELSE trim({c}) END"
    if tokens:
        t = f"CASE WHEN ({t}) IN ('NULL', 'null', 'N/A', 'NA', '') THEN NULL ELSE ({t}) END"
    return t


def _first(cols, key):
    order = ", ".join(f"{c} NULLS FIRST" for c in cols if c != key)
    return f"row_number() OVER (PARTITION BY {key} ORDER BY {order})"


_O_COLS = ["order_id", "customer_id", "product_id", "order_date", "ship_date", "quantity", "unit_price",
           "discount_pct", "total_amount", "payment_method", "order_status"]
_O_STR = ["product_id", "order_date", "ship_date", "unit_price", "discount_pct", "total_amount", "payment_method", "order_status"]

CLEAN_ORDERS_SQL = f"""WITH {_RAW_ORDERS_SQL},
d AS (SELECT * EXCLUDE (rn) FROM (SELECT *, {_first(_O_COLS, 'order_id')} AS rn FROM raw_o) WHERE rn = 1),
t AS (SELECT order_id, customer_id, quantity, {", ".join(f"{_tidy(c, True)} AS {c}" for c in _O_STR)} FROM d),
p AS (SELECT order_id, customer_id, quantity,
        CASE WHEN regexp_matches(product_id, '^P\\d+$') THEN product_id END AS product_id,
        {_DATE.format(c='order_date')} AS order_date, {_DATE.format(c='ship_date')} AS ship_date,
        replace(unit_price, '$', '') AS unit_price, discount_pct, replace(total_amount, '$', '') AS total_amount,
        payment_method, order_status FROM t),
f AS (SELECT * FROM p WHERE regexp_matches(unit_price, '^\\d+(\\.\\d+)?$') AND regexp_matches(discount_pct, '^\\d+(\\.\\d+)?$')
        AND regexp_matches(total_amount, '^\\d+(\\.\\d+)?$')),
c AS (SELECT order_id, customer_id, product_id, order_date,
        CASE WHEN ship_date >= order_date THEN ship_date END AS ship_date, quantity,
        CAST(unit_price AS DECIMAL(18,6)) AS unit_price, TRY_CAST(discount_pct AS DECIMAL(9,6)) AS discount_pct,
        payment_method, order_status FROM f),
g AS (SELECT * FROM c WHERE quantity > 0 AND unit_price > 0),
h AS (SELECT order_id, customer_id, product_id, order_date, ship_date, quantity, unit_price,
        CASE WHEN discount_pct BETWEEN 0 AND 100 THEN discount_pct ELSE CAST(0 AS DECIMAL(9,6)) END AS discount_pct,
        CASE WHEN payment_method IN ('Visa', 'MasterCard') THEN 'Credit Card' WHEN payment_method = 'Debit' THEN 'Debit Card'
             ELSE payment_method END AS payment_method,
        CASE WHEN order_status IN ('Delivered', 'Pending', 'Cancelled', 'Returned', 'Shipped') THEN order_status END AS order_status
      FROM g)
SELECT order_id, customer_id, product_id, order_date, ship_date, quantity, unit_price, discount_pct,
  CAST(round(CAST(quantity * unit_price AS DECIMAL(22,6)) * CAST(100 - discount_pct AS DECIMAL(9,6)) * CAST(0.01 AS DECIMAL(3,2)), 2) AS DECIMAL(18,2)) AS total_amount,
  payment_method, order_status
FROM h WHERE order_id IS NOT NULL AND customer_id IS NOT NULL AND product_id IS NOT NULL AND order_date IS NOT NULL
  AND quantity IS NOT NULL AND unit_price IS NOT NULL"""

_RAW_CUSTOMERS_SQL = """
base_c AS (SELECT c_custkey AS customer_id,
  CASE WHEN c_custkey % 17 = 0 THEN '  ' WHEN c_custkey % 11 = 0 THEN ' ' || split_part(c_name, '#', 1) || ' '
       ELSE split_part(c_name, '#', 1) END AS first_name,
  split_part(c_name, '#', 2) AS last_name,
  CASE WHEN c_custkey % 13 = 0 THEN 'cust' || CAST(c_custkey AS VARCHAR) || '@bad'
       WHEN c_custkey % 7 = 0 THEN 'CUST' || CAST(c_custkey AS VARCHAR) || '@EXAMPLE.COM'
       ELSE 'cust' || CAST(c_custkey AS VARCHAR) || '@example.com' END AS email,
  CASE WHEN c_custkey % 9 = 0 THEN '555-1234' WHEN c_custkey % 10 = 0 THEN '1234567890123456'
       ELSE '+1 (' || lpad(CAST(c_nationkey + 100 AS VARCHAR), 3, '0') || ') ' || substr(lpad(CAST(c_custkey AS VARCHAR), 7, '0'), 1, 3)
            || '-' || substr(lpad(CAST(c_custkey AS VARCHAR), 7, '0'), 4, 4) END AS phone,
  CASE WHEN c_custkey % 53 = 0 THEN '2024-02-30'
       WHEN c_custkey % 4 = 0 THEN strftime(DATE '2020-01-01' + CAST(c_custkey % 1000 AS INTEGER), '%Y/%m/%d')
       WHEN c_custkey % 4 = 1 THEN strftime(DATE '2020-01-01' + CAST(c_custkey % 1000 AS INTEGER), '%m-%d-%Y')
       ELSE strftime(DATE '2020-01-01' + CAST(c_custkey % 1000 AS INTEGER), '%Y-%m-%d') END AS signup_date,
  CASE c_custkey % 5 WHEN 0 THEN 'USA' WHEN 1 THEN 'U.S.A.' WHEN 2 THEN 'united states' WHEN 3 THEN 'canada' ELSE 'Mexico' END AS country,
  CASE c_custkey % 4 WHEN 0 THEN 'mn' WHEN 1 THEN 'Minnesota' WHEN 2 THEN ' ca ' ELSE NULL END AS state,
  lpad(CAST(c_custkey % 100000 AS VARCHAR), 5, '0') AS postal_code,
  CASE c_custkey % 6 WHEN 0 THEN 'yes' WHEN 1 THEN 'N' WHEN 2 THEN 'TRUE' WHEN 3 THEN 'false' WHEN 4 THEN 'maybe' ELSE 'Y' END AS is_active,
  CASE WHEN c_custkey % 8 = 0 THEN NULL WHEN c_custkey % 8 = 1 THEN -5 ELSE CAST(floor(c_acctbal) AS INTEGER) END AS loyalty_points
  FROM customer),
raw_c AS (SELECT * FROM base_c UNION ALL SELECT * REPLACE (loyalty_points + 1 AS loyalty_points) FROM base_c WHERE customer_id % 89 = 0)"""

_C_COLS = ["customer_id", "first_name", "last_name", "email", "phone", "signup_date", "country", "state",
           "postal_code", "is_active", "loyalty_points"]
_C_STR = ["first_name", "last_name", "email", "phone", "signup_date", "country", "state", "postal_code", "is_active"]

CLEAN_CUSTOMERS_SQL = f"""WITH {_RAW_CUSTOMERS_SQL},
d AS (SELECT * EXCLUDE (rn) FROM (SELECT *, {_first(_C_COLS, 'customer_id')} AS rn FROM raw_c) WHERE rn = 1),
t AS (SELECT customer_id, loyalty_points, {", ".join(f"{_tidy(c)} AS {c}" for c in _C_STR)} FROM d),
c AS (SELECT customer_id, first_name, last_name,
  CASE WHEN regexp_matches(email, '^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\\.[A-Za-z]{{2,}}$') THEN lower(email) END AS email,
  CASE WHEN length(regexp_replace(phone, '\\D', '', 'g')) BETWEEN 10 AND 15 THEN regexp_replace(phone, '\\D', '', 'g') END AS phone,
  {_DATE.format(c='signup_date')} AS signup_date,
  CASE WHEN upper(country) IN ('USA', 'U.S.A.', 'UNITED STATES') THEN 'USA' WHEN upper(country) = 'CANADA' THEN 'Canada' ELSE country END AS country,
  CASE WHEN upper(state) = 'MINNESOTA' THEN 'MN' ELSE upper(state) END AS state,
  postal_code,
  CASE WHEN upper(trim(is_active)) IN ('TRUE', 'YES', 'Y') THEN TRUE WHEN upper(trim(is_active)) IN ('FALSE', 'NO', 'N') THEN FALSE END AS is_active,
  greatest(coalesce(loyalty_points, 0), 0) AS loyalty_points FROM t)
SELECT * FROM c WHERE customer_id IS NOT NULL AND first_name IS NOT NULL AND last_name IS NOT NULL AND email IS NOT NULL
  AND signup_date IS NOT NULL"""

_RAW_PRODUCTS_SQL = """
p0 AS (SELECT *, CAST(p_retailprice AS DECIMAL(18,2)) AS pr FROM part),
base_p AS (SELECT
  CASE WHEN p_partkey % 29 = 0 THEN 'X' || CAST(p_partkey AS VARCHAR) ELSE 'P' || CAST(p_partkey AS VARCHAR) END AS product_id,
  p_name AS product_name, p_type AS category,
  CASE WHEN p_partkey % 19 = 0 THEN '' ELSE lower(p_brand) END AS brand,
  CASE WHEN p_partkey % 37 = 0 THEN 'abc' WHEN p_partkey % 31 = 0 THEN '1,299.99'
       WHEN p_partkey % 7 = 0 THEN replace(CAST(pr AS VARCHAR), '.', ',')
       WHEN p_partkey % 3 = 0 THEN '$' || CAST(pr AS VARCHAR)
       WHEN p_partkey % 5 = 0 THEN CAST(pr AS VARCHAR) || '5' ELSE CAST(pr AS VARCHAR) END AS price,
  CASE WHEN p_partkey % 41 = 0 THEN '-5.00' WHEN p_partkey % 11 = 0 THEN '$' || CAST(pr - 100 AS VARCHAR)
       ELSE CAST(pr - 100 AS VARCHAR) END AS cost,
  CASE WHEN p_partkey % 13 = 0 THEN NULL ELSE p_size * 10 - 50 END AS stock_quantity,
  CASE WHEN p_partkey % 43 = 0 THEN 'heavy' WHEN p_partkey % 4 = 0 THEN CAST(p_size AS VARCHAR) || '.125' ELSE CAST(p_size AS VARCHAR) || '.5' END AS weight_kg,
  CASE WHEN p_partkey % 47 = 0 THEN '13-45-2020'
       WHEN p_partkey % 3 = 0 THEN strftime(DATE '2019-01-01' + CAST(p_partkey % 1500 AS INTEGER), '%m-%d-%Y')
       WHEN p_partkey % 3 = 1 THEN strftime(DATE '2019-01-01' + CAST(p_partkey % 1500 AS INTEGER), '%Y/%m/%d')
       ELSE strftime(DATE '2019-01-01' + CAST(p_partkey % 1500 AS INTEGER), '%Y-%m-%d') END AS created_date,
  CASE p_partkey % 5 WHEN 0 THEN 'Yes' WHEN 1 THEN 'no' WHEN 2 THEN ' y ' WHEN 3 THEN 'FALSE' ELSE 'maybe' END AS is_active
  FROM p0),
raw_p AS (SELECT * FROM base_p UNION ALL
  SELECT * REPLACE (stock_quantity + 1 AS stock_quantity) FROM base_p WHERE CAST(substr(product_id, 2) AS BIGINT) % 83 = 0)"""

_P_COLS = ["product_id", "product_name", "category", "brand", "price", "cost", "stock_quantity", "weight_kg",
           "created_date", "is_active"]
_P_STR = ["product_id", "product_name", "category", "brand", "price", "cost", "weight_kg", "created_date", "is_active"]

CLEAN_PRODUCTS_SQL = f"""WITH {_RAW_PRODUCTS_SQL},
d AS (SELECT * EXCLUDE (rn) FROM (SELECT *, {_first(_P_COLS, 'product_id')} AS rn FROM raw_p) WHERE rn = 1),
t AS (SELECT stock_quantity, {", ".join(f"{_tidy(c)} AS {c}" for c in _P_STR)} FROM d),
a AS (SELECT CASE WHEN regexp_matches(product_id, '^P\\d+$') THEN product_id END AS product_id, product_name, category, brand,
        replace(replace(price, '$', ''), ',', '.') AS price, replace(cost, '$', '') AS cost, stock_quantity, weight_kg,
        created_date, is_active FROM t),
b AS (SELECT * FROM a WHERE regexp_matches(price, '^\\d+(\\.\\d+)?$') AND regexp_matches(cost, '^\\d+(\\.\\d+)?$')
        AND regexp_matches(weight_kg, '^\\d+(\\.\\d+)?$')),
c AS (SELECT product_id, product_name, category, brand, CAST(price AS DECIMAL(18,6)) AS price, CAST(cost AS DECIMAL(18,6)) AS cost,
        stock_quantity, CAST(weight_kg AS DECIMAL(18,6)) AS weight_kg, {_DATE.format(c='created_date')} AS created_date,
        CASE WHEN upper(trim(is_active)) IN ('TRUE', 'YES', 'Y') THEN TRUE WHEN upper(trim(is_active)) IN ('FALSE', 'NO', 'N') THEN FALSE END AS is_active
      FROM b),
e AS (SELECT product_id, product_name, category,
        upper(substr(brand, 1, 1)) || lower(substr(brand, 2)) AS brand, price, cost,
        CASE WHEN stock_quantity < 0 THEN 0 ELSE stock_quantity END AS stock_quantity,
        CASE WHEN weight_kg >= 0 THEN weight_kg END AS weight_kg, created_date, is_active
      FROM c WHERE price > 0 AND cost >= 0)
SELECT * FROM e WHERE product_id IS NOT NULL AND product_name IS NOT NULL AND category IS NOT NULL AND brand IS NOT NULL
  AND price IS NOT NULL AND cost IS NOT NULL AND created_date IS NOT NULL AND is_active IS NOT NULL"""


@register("clean_orders", CLEAN_ORDERS_SQL, "C2 P16 P17 P19 P23 P24 F6 F8 F9 F10 F14 F15 F18 F19 F20 F22 F31 A16")
def clean_orders_q(spark, sf):
    t = Tables(spark, sf, spread=True)
    return cleaning.clean_orders(raw_orders(t.lineitem, t.orders))


@register("clean_customers", CLEAN_CUSTOMERS_SQL, "C1 P19 P22 P23 F11 F15 F22 F30 F31 F32 A16")
def clean_customers_q(spark, sf):
    return cleaning.clean_customers(raw_customers(Tables(spark, sf, spread=True).customer))


@register("clean_products", CLEAN_PRODUCTS_SQL, "C3 P19 P23 F12 F14 F15 F22 F30 A16")
def clean_products_q(spark, sf):
    return cleaning.clean_products(raw_products(Tables(spark, sf, spread=True).part))


def _strip_with(sql: str) -> str:
    return sql[len("WITH "):]


_CLEAN_CTES = f"""WITH co AS ({CLEAN_ORDERS_SQL}), cc AS ({CLEAN_CUSTOMERS_SQL}), cp AS ({CLEAN_PRODUCTS_SQL})"""


@register(
    "clean_revenue_by_category",
    f"""{_CLEAN_CTES}
SELECT cp.category, CAST(sum(co.total_amount) AS DECIMAL(28,2)) AS total_revenue, count(co.order_id) AS total_orders
FROM co JOIN cc ON co.customer_id = cc.customer_id JOIN cp ON co.product_id = cp.product_id GROUP BY cp.category""",
    "C4 C5 A18 J2 J11",
)
def clean_revenue_by_category(spark, sf):
    """C1–C3 written once as Parquet (shared checkpoint folder), then C4 + C5 read from
    those files: revenue and order count per category."""
    from tidewater.streaming.events import new_run_dir

    t = Tables(spark, sf, spread=True)
    tables = cleaning.publish_clean_tables(
        raw_orders(t.lineitem, t.orders), raw_customers(t.customer), raw_products(t.part), new_run_dir(spark, "clean")
    )
    d = cleaning.order_details(tables["orders"], tables["customers"], tables["products"])
    return d.groupBy("category").agg(F.sum("total_amount").alias("total_revenue"), F.count("order_id").alias("total_orders"))


# ---- the same jobs from raw CSV folders ------------------------------------------------


def _csv_triple(spark, sf, run, names=("orders", "customers", "products")):
    """Header CSV folders of the raw triple (or those of ``names``); every 59th order id is text, so its line is malformed."""
    t = Tables(spark, sf, spread=True)
    orders = raw_orders(t.lineitem, t.orders)
    broken = F.when(F.col("order_id") % 59 == 0, F.concat(F.lit("no-"), F.col("order_id"))).otherwise(F.col("order_id").cast("string"))
    raw = {"orders": orders.withColumn("order_id", broken), "customers": raw_customers(t.customer), "products": raw_products(t.part)}
    for name in names:
        # compressed files are read whole, so they are kept short
        csv = raw[name].write.option("header", True).option("compression", "gzip").option("maxRecordsPerFile", 1_000_000)
        with shuffles_dropped(spark):
            csv.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(f"{run}/{name}")
    return tuple(f"{run}/{n}" for n in names)


@register("clean_orders_from_csv", f"SELECT * FROM ({CLEAN_ORDERS_SQL}) WHERE order_id % 59 <> 0", "S8 S16 C2 F28")
def clean_orders_from_csv(spark, sf):
    """The raw orders as a CSV folder, read with the declared schema (malformed lines set aside), then C2."""
    from tidewater.plans.jobs import RAW_ORDERS
    from tidewater.sources.intake import FILE, FOLDER, ingest_csv
    from tidewater.streaming.events import new_run_dir

    run = new_run_dir(spark, "orders-csv")
    (orders,) = _csv_triple(spark, sf, run, ("orders",))
    taken = ingest_csv(spark, orders, RAW_ORDERS, f"{run}/raw", required=("order_id",))
    clean = cleaning.clean_orders(taken.good.drop(FILE, FOLDER))
    return clean.withColumns({c: F.col(c).cast("long") for c in ("order_id", "customer_id")})


@register(
    "commerce_job_top_customers",
    f"""{_CLEAN_CTES},
s AS (SELECT co.customer_id, cc.first_name, cc.last_name, CAST(sum(co.total_amount) AS DECIMAL(28,2)) AS total_spent
  FROM co JOIN cc ON co.customer_id = cc.customer_id JOIN cp ON co.product_id = cp.product_id WHERE co.order_id % 59 <> 0 GROUP BY 1, 2, 3)
SELECT CAST(customer_id AS BIGINT) AS customer_id, first_name, last_name, total_spent,
  CAST(row_number() OVER (ORDER BY total_spent DESC, customer_id) AS INTEGER) AS rank,
  (SELECT count(*) FROM raw_lines WHERE order_id % 59 = 0) AS n_rejected
FROM s ORDER BY total_spent DESC, customer_id LIMIT 10""".replace("WITH co AS", f"WITH raw_lines AS (WITH {_RAW_ORDERS_SQL} SELECT order_id FROM raw_o), co AS", 1),
    "C1 C2 C3 C4 C5 S8 S16 O3 K1",
)
def commerce_job_top_customers(spark, sf):
    """C1–C5 as one job from three raw CSV folders: the ten best customers in order, and the lines set aside."""
    from tidewater.plans.jobs import commerce_etl
    from tidewater.streaming.events import new_run_dir

    run = new_run_dir(spark, "commerce-job")
    out = commerce_etl(spark, *_csv_triple(spark, sf, run), f"{run}/out", quarantine=True)
    rejected = out["rejected"].agg(F.sum("n_bad")).scalar()
    return out["top_customers"].select(F.col("customer_id").cast("long").alias("customer_id"), "first_name", "last_name", "total_spent", "rank", rejected.alias("n_rejected"))
