"""Bronze, silver and gold over the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarrylake.operators.latest import keep_latest, keep_latest_delivery
from quarrylake.operators.quality_rules import split_by_status, validate_required_fields
from quarrylake.plans import gold
from quarrylake.plans.silver import rejects
from quarrylake.queries import query
from quarrylake.queries.inputs import (
    SQL_CUSTOMERS,
    SQL_DELIVERIES,
    SQL_FACT,
    SQL_PRODUCTS,
    Inputs,
)
from quarrylake.schemas import CUSTOMERS, ORDERS


@query(f"""
WITH {SQL_DELIVERIES}
SELECT order_id, customer_id, order_date, total_amount, status, _ingestion_timestamp,
  _validation_errors, _record_status
FROM bronze
""")
def validate_orders(inputs: Inputs) -> DataFrame:
    return inputs.bronze_orders.select(
        "order_id", "customer_id", "order_date", "total_amount", "status",
        "_ingestion_timestamp", "_validation_errors", "_record_status",
    )


@query(f"""
WITH {SQL_DELIVERIES}
SELECT 'raw' AS part, count(*) AS records FROM bronze WHERE _record_status = 'valid'
UNION ALL
SELECT 'invalid', count(*) FROM bronze WHERE _record_status = 'invalid'
""")
def quarantine_split_counts(inputs: Inputs) -> DataFrame:
    valid, invalid = split_by_status(inputs.bronze_orders)
    counts = [
        part.agg(F.count("*").alias("records")).select(F.lit(name).alias("part"), "records")
        for name, part in (("raw", valid), ("invalid", invalid))
    ]
    return counts[0].unionByName(counts[1])


@query("""
SELECT CAST(c_custkey AS VARCHAR) AS customer_id, 'missing_email' AS _validation_errors,
  'invalid' AS _record_status
FROM customer JOIN nation ON c_nationkey = n_nationkey
""")
def validation_missing_column(inputs: Inputs) -> DataFrame:
    without = inputs.customer_messages().drop("email")
    checked = validate_required_fields(without, CUSTOMERS.required)
    return checked.select("customer_id", "_validation_errors", "_record_status")


@query("""
SELECT CAST(p_partkey AS VARCHAR) AS product_id, CAST(NULL AS VARCHAR) AS _validation_errors,
  'valid' AS _record_status
FROM part
""")
def validation_without_rules(inputs: Inputs) -> DataFrame:
    checked = validate_required_fields(inputs.product_messages(), [])
    return checked.select("product_id", "_validation_errors", "_record_status")


@query(f"""
WITH {SQL_DELIVERIES}
SELECT order_id, status, _ingestion_timestamp FROM bronze WHERE _record_status = 'valid'
QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY _ingestion_timestamp DESC) = 1
""")
def keep_latest_orders(inputs: Inputs) -> DataFrame:
    valid, _ = split_by_status(inputs.bronze_orders)
    return keep_latest(
        valid.select("order_id", "status", "_ingestion_timestamp"), ["order_id"], ["_ingestion_timestamp"]
    )


@query("""
SELECT o_custkey, o_orderkey, o_orderdate, o_orderstatus FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1
""")
def last_order_per_customer(inputs: Inputs) -> DataFrame:
    orders = inputs.table("orders").select("o_custkey", "o_orderkey", "o_orderdate", "o_orderstatus")
    return keep_latest(orders, ["o_custkey"], ["o_orderdate", "o_orderkey"])


@query(f"""
WITH {SQL_DELIVERIES}
SELECT status, count(*) AS records FROM (
  SELECT * FROM bronze WHERE _record_status = 'valid'
  QUALIFY rank() OVER (PARTITION BY order_id ORDER BY _ingestion_timestamp DESC) = 1
) GROUP BY status
""")
def keep_latest_delivery_counts(inputs: Inputs) -> DataFrame:
    valid, _ = split_by_status(inputs.bronze_orders)
    last = keep_latest_delivery(valid, ["order_id"], "_ingestion_timestamp")
    return last.groupBy("status").agg(F.count("*").alias("records"))


@query(f"WITH {SQL_FACT} SELECT * FROM fact")
def fact_orders(inputs: Inputs) -> DataFrame:
    return inputs.fact_orders


@query(f"""
WITH {SQL_DELIVERIES}
SELECT order_id, order_date, status, _ingestion_timestamp FROM bronze
WHERE _record_status = 'valid' AND TRY_CAST(order_date AS TIMESTAMP) IS NULL
""")
def silver_rejects(inputs: Inputs) -> DataFrame:
    return rejects(inputs.bronze_orders, ORDERS).select(
        "order_id", "order_date", "status", "_ingestion_timestamp"
    )


@query(f"WITH {SQL_CUSTOMERS} SELECT * FROM dim_customers")
def dim_customers(inputs: Inputs) -> DataFrame:
    return inputs.dim_customers


@query(f"WITH {SQL_PRODUCTS} SELECT * FROM dim_products")
def dim_products(inputs: Inputs) -> DataFrame:
    return inputs.dim_products


def _summary_sql(condition: str) -> str:
    return f"""
WITH {SQL_FACT}, {SQL_CUSTOMERS}
SELECT o.order_id, o.order_date, o.total_amount, o.status AS order_status, o.payment_method,
  c.customer_id, c.name AS customer_name, c.email_salt_key, c.city AS customer_city,
  c.state AS customer_state, c.country AS customer_country, o._silver_processed_at
FROM fact o LEFT JOIN dim_customers c ON o.customer_id = c.customer_id
WHERE {condition}
"""


@query(_summary_sql("true"))
def order_summary(inputs: Inputs) -> DataFrame:
    return gold.order_summary(inputs.fact_orders, inputs.dim_customers)


@query(_summary_sql("CAST(o.order_date AS DATE) BETWEEN DATE '1998-01-01' AND DATE '1998-03-31'"))
def order_summary_in_range(inputs: Inputs) -> DataFrame:
    summary = gold.order_summary(inputs.fact_orders, inputs.dim_customers)
    by_day = summary.withColumn("_day", F.to_date("order_date"))
    return gold.in_date_range(by_day, "_day", "1998-01-01", "1998-03-31").drop("_day")


def _value_sql(orders: str) -> str:
    return f"""
WITH {SQL_FACT}, {SQL_CUSTOMERS}, chosen AS ({orders})
SELECT c.customer_id, c.name AS customer_name, c.email_salt_key, c.city, c.state, c.country,
  c.created_at AS customer_since, count(DISTINCT o.order_id) AS total_orders,
  sum(o.total_amount) AS total_spend, avg(o.total_amount) AS avg_order_value,
  min(o.order_date) AS first_order_date, max(o.order_date) AS last_order_date,
  CAST(datediff('day', min(o.order_date), max(o.order_date)) AS INTEGER) AS customer_tenure_days
FROM dim_customers c LEFT JOIN chosen o ON c.customer_id = o.customer_id
GROUP BY c.customer_id, c.name, c.email_salt_key, c.city, c.state, c.country, c.created_at
"""


@query(_value_sql("SELECT * FROM fact"), rounded=("total_spend", "avg_order_value"))
def customer_lifetime_value(inputs: Inputs) -> DataFrame:
    return gold.customer_lifetime_value(inputs.dim_customers, inputs.fact_orders)


@query(_value_sql("SELECT * FROM fact WHERE order_date BETWEEN DATE '1998-01-01' AND DATE '1998-03-31'"), rounded=("total_spend", "avg_order_value"))
def customer_value_in_range(inputs: Inputs) -> DataFrame:
    """Most customers have no order in the range: they stay with 0 orders."""
    chosen = gold.in_date_range(
        inputs.fact_orders.withColumn("_day", F.to_date("order_date")), "_day", "1998-01-01", "1998-03-31"
    )
    return gold.customer_lifetime_value(inputs.dim_customers, chosen.drop("_day"))


_ITEMS = """messages AS (
  SELECT b.order_id || concat_ws('-', '', l_linenumber, l_partkey, l_suppkey, CAST(l_quantity AS INTEGER)) AS order_id,
    b.order_date, CASE WHEN b.payment_method = '1-URGENT' THEN TIMESTAMP '2002-01-01 00:00:00'
      ELSE b._ingestion_timestamp END AS _ingestion_timestamp,
    CAST(l_partkey AS VARCHAR) AS product_id, CAST(l_quantity AS INTEGER) AS whole,
    l_extendedprice / l_quantity AS unit_price
  FROM bronze b JOIN lineitem ON l_orderkey = o_orderkey
  WHERE b._record_status = 'valid'
), items AS (
  SELECT m.*, quantity, quantity * unit_price AS line_total
  FROM messages m, LATERAL (SELECT unnest([whole // 2, whole - whole // 2]) AS quantity)
), last_messages AS (
  SELECT * FROM messages QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY _ingestion_timestamp DESC) = 1
)"""


@query(f"""
WITH {SQL_DELIVERIES}, {_ITEMS}
SELECT order_id, order_date, product_id, quantity, unit_price, line_total FROM items
""")
def order_items(inputs: Inputs) -> DataFrame:
    return gold.order_items(inputs.bronze_orders_with_items)


def _sales_sql(items: str) -> str:
    return f"""
WITH {SQL_DELIVERIES}, {SQL_PRODUCTS}, {_ITEMS}, chosen AS ({items})
SELECT p.product_id, p.name AS product_name, p.category, p.brand, p.price AS current_price,
  p.name_salt_key, count(DISTINCT i.order_id) AS times_ordered,
  coalesce(sum(i.line_total), 0) AS total_revenue,
  avg(i.line_total) AS avg_line_value,
  min(i.order_date) AS first_sale_date, max(i.order_date) AS last_sale_date
FROM dim_products p LEFT JOIN chosen i ON p.product_id = i.product_id
GROUP BY p.product_id, p.name, p.category, p.brand, p.price, p.name_salt_key
"""


@query(_sales_sql("SELECT * FROM items"), rounded=("total_revenue", "avg_line_value"))
def product_sales(inputs: Inputs) -> DataFrame:
    return gold.product_sales(inputs.dim_products, inputs.bronze_orders_with_items)


@query(_sales_sql("""
  SELECT m.*, quantity, quantity * unit_price AS line_total
  FROM last_messages m, LATERAL (SELECT unnest([whole // 2, whole - whole // 2]) AS quantity)
"""), rounded=("total_revenue", "avg_line_value"))
def product_sales_dedup(inputs: Inputs) -> DataFrame:
    return gold.product_sales_dedup(inputs.dim_products, inputs.bronze_orders_with_items)


@query(_sales_sql("SELECT * FROM items WHERE order_date BETWEEN '2001-07-30' AND '2001-08-01T23:59:59Z'"), rounded=("total_revenue", "avg_line_value"))
def product_sales_in_range(inputs: Inputs) -> DataFrame:
    """Most products have no sale in the range: they stay with 0 revenue."""
    chosen = gold.in_date_range(
        inputs.bronze_orders_with_items, "order_date", "2001-07-30", "2001-08-01T23:59:59Z"
    )
    return gold.product_sales(inputs.dim_products, chosen)


@query(f"""
WITH {SQL_FACT}, {SQL_CUSTOMERS}
SELECT c.country AS country, count(*) AS orders, sum(o.total_amount) AS amount
FROM fact o JOIN dim_customers c ON o.customer_id = c.customer_id GROUP BY c.country
""", rounded=("amount",))
def gold_views_in_sql(inputs: Inputs) -> DataFrame:
    """The registered views, read with SQL text."""
    gold.create_gold_views(
        inputs.spark, inputs.fact_orders, inputs.dim_customers, inputs.dim_products,
        inputs.bronze_orders_with_items,
    )
    return inputs.spark.sql("""
        SELECT customer_country AS country, count(*) AS orders,
          sum(total_amount) AS amount
        FROM vw_order_summary WHERE customer_id IS NOT NULL GROUP BY customer_country
    """)
