"""The given tables in the shape of the three topics, in Spark and, apart, in SQL.

Faults and redeliveries follow from the data itself, so that SQL can restate them:
customers with a negative balance come without an e-mail, some orders lack their
customer or amount or have an unreadable date, and every finished order was first
delivered as open and an hour later as finished.
"""

from __future__ import annotations

from datetime import datetime
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarrylake.operators.quality_rules import validate_required_fields
from quarrylake.plans.silver import conform
from quarrylake.schemas import CUSTOMERS, ORDERS, PRODUCTS

FIRST_DELIVERY = datetime(2002, 1, 1, 0, 0)
SECOND_DELIVERY = datetime(2002, 1, 1, 1, 0)
PROCESSED_AT = datetime(2002, 1, 2, 0, 0)
SALT = "not-a-secret"


def stamp(moment: datetime) -> Column:
    return F.lit(moment).cast("timestamp")


def whole_text(name: str) -> Column:
    return F.col(name).cast("int").cast("string")


def _iso_day(moment: Column) -> Column:
    """Midnight of the day as text; the given dates are all at midnight."""
    return F.concat(F.to_date(moment).cast("string"), F.lit("T00:00:00Z"))


class Inputs:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    # --- raw topics -------------------------------------------------------------

    def _order_columns(self, status: Column) -> list[Column]:
        price, date = F.col("o_totalprice"), F.col("o_orderdate")
        no_customer = (F.col("o_orderstatus") == "P") & (F.col("o_orderpriority") == "5-LOW")
        unreadable = price.between(490000, 495000)
        return [
            F.when(price < 2000, F.lit("  ")).otherwise(F.col("o_orderkey").cast("string")).alias("order_id"),
            F.when(~no_customer, F.col("o_custkey").cast("string")).alias("customer_id"),
            F.when(unreadable, F.date_format(date, "dd/MM/yyyy"))
            .otherwise(_iso_day(date))
            .alias("order_date"),
            F.when(price <= 495000, price).alias("total_amount"),
            status.alias("status"),
            F.col("o_orderpriority").alias("payment_method"),
            F.lit(None).cast("string").alias("shipping_address_id"),
        ]

    def order_messages(self) -> DataFrame:
        """Each order as it stands, delivered once, without its items."""
        return self.table("orders").select(*self._order_columns(F.col("o_orderstatus")))

    def order_messages_with_items(self) -> DataFrame:
        """The same messages, each with one item per line of its order."""
        item = F.struct(
            F.col("l_partkey").cast("string").alias("product_id"),
            F.col("l_quantity").cast("int").alias("quantity"),
            (F.col("l_extendedprice") / F.col("l_quantity")).alias("unit_price"),
        )
        items = self.table("lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.collect_list(item).alias("items"))
        orders = self.table("orders").join(items, "o_orderkey", "left")
        return orders.select(*self._order_columns(F.col("o_orderstatus")), "items")

    def _delivered(self, orders: DataFrame, extra: list[Column], later: Column | None = None) -> DataFrame:
        """One row per delivery: finished orders come twice, first as open, then at ``later``."""
        later = stamp(SECOND_DELIVERY) if later is None else later
        first = F.struct(
            F.lit("O").alias("status"), stamp(FIRST_DELIVERY).alias("at"), F.lit("first.json").alias("file")
        )
        second = F.struct(
            F.lit("F").alias("status"), later.alias("at"), F.lit("second.json").alias("file")
        )
        only = F.struct(
            F.col("o_orderstatus").alias("status"), stamp(FIRST_DELIVERY).alias("at"),
            F.lit("first.json").alias("file"),
        )
        deliveries = F.when(F.col("o_orderstatus") == "F", F.array(first, second)).otherwise(F.array(only))
        rows = orders.withColumn("_delivery", F.explode(deliveries))
        return rows.select(
            *self._order_columns(F.col("_delivery.status")),
            *extra,
            F.col("_delivery.at").alias("_ingestion_timestamp"),
            F.col("_delivery.file").alias("_source_file"),
        )

    def order_deliveries(self) -> DataFrame:
        return self._delivered(self.table("orders"), [])

    def order_deliveries_with_items(self) -> DataFrame:
        """A message of its own, with two items, per order line; orders without lines have no items.

        The line's place names its message and its quantity is dealt to the two items.
        Finished urgent orders come twice in one batch, other finished ones in two.
        """
        # an inner join can split an order with very many lines, an outer one cannot
        orders, line = self.table("orders"), self.table("lineitem")
        line = line.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")

        def item(quantity: str) -> Column:
            return F.struct(
                F.col("l_partkey").cast("string").alias("product_id"),
                F.expr(quantity).cast("int").alias("quantity"),
                (F.col("l_extendedprice") / F.col("l_quantity")).alias("unit_price"),
            )

        whole = "cast(l_quantity as int)"
        both = F.array(item(f"{whole} div 2"), item(f"{whole} - {whole} div 2"))
        part = F.concat_ws("-", F.lit(""), "l_linenumber", "l_partkey", "l_suppkey", whole_text("l_quantity"))
        with_lines = line.join(orders, F.col("o_orderkey") == F.col("l_orderkey"))
        sold = line.select(F.col("l_orderkey").alias("o_orderkey")).distinct()
        without = orders.join(sold, "o_orderkey", "left_anti")
        rows = with_lines.select(*orders.columns, both.alias("items"), part.alias("_part")).unionByName(
            without, allowMissingColumns=True
        )
        same_batch = F.col("o_orderpriority") == "1-URGENT"
        later = F.when(same_batch, stamp(FIRST_DELIVERY)).otherwise(stamp(SECOND_DELIVERY))
        sent = self._delivered(rows, [F.col("items"), F.coalesce("_part", F.lit("")).alias("_part")], later)
        named = F.when(F.trim("order_id") == "", F.col("order_id")).otherwise(F.concat("order_id", "_part"))
        return sent.withColumn("order_id", named).drop("_part")

    def customer_messages(self) -> DataFrame:
        nation, region = self.table("nation"), self.table("region")
        places = nation.join(region, nation.n_regionkey == region.r_regionkey)
        created = F.date_add(F.lit("1994-01-01").cast("date"), F.col("c_nationkey") * 10)
        return (
            self.table("customer")
            .join(places, F.col("c_nationkey") == F.col("n_nationkey"))
            .select(
                F.col("c_custkey").cast("string").alias("customer_id"),
                F.when(F.col("c_acctbal") >= 0, F.concat(F.lower("c_name"), F.lit("@example.com"))).alias("email"),
                F.col("c_name").alias("name"),
                F.lit(None).cast("string").alias("phone"),
                F.lit(None).cast("string").alias("address"),
                F.col("c_mktsegment").alias("city"),
                F.col("n_name").alias("state"),
                F.col("r_name").alias("country"),
                F.lit(None).cast("string").alias("postal_code"),
                _iso_day(created).alias("created_at"),
                _iso_day(F.date_add(created, 30)).alias("updated_at"),
                F.col("c_acctbal").alias("lifetime_value"),
            )
        )

    def product_messages(self) -> DataFrame:
        return self.table("part").select(
            F.col("p_partkey").cast("string").alias("product_id"),
            F.col("p_name").alias("name"),
            F.when(F.col("p_size") < 50, F.col("p_retailprice")).alias("price"),
            F.col("p_type").alias("category"),
            F.lit(None).cast("string").alias("description"),
            F.col("p_brand").alias("brand"),
            F.lit(None).cast("string").alias("sku"),
            F.col("p_size").cast("double").alias("weight"),
            F.lit("1994-01-01T00:00:00Z").alias("created_at"),
            F.lit("1994-02-01T00:00:00Z").alias("updated_at"),
        )

    # --- bronze and silver --------------------------------------------------------

    def _once(self, messages: DataFrame) -> DataFrame:
        return messages.withColumns(
            {"_ingestion_timestamp": stamp(FIRST_DELIVERY), "_source_file": F.lit("first.json")}
        )

    @cached_property
    def bronze_orders(self) -> DataFrame:
        return validate_required_fields(self.order_deliveries(), ORDERS.required)

    @cached_property
    def bronze_orders_with_items(self) -> DataFrame:
        return validate_required_fields(self.order_deliveries_with_items(), ORDERS.required)

    @cached_property
    def bronze_customers(self) -> DataFrame:
        return validate_required_fields(self._once(self.customer_messages()), CUSTOMERS.required)

    @cached_property
    def bronze_products(self) -> DataFrame:
        return validate_required_fields(self._once(self.product_messages()), PRODUCTS.required)

    @cached_property
    def fact_orders(self) -> DataFrame:
        return conform(self.bronze_orders, ORDERS, PROCESSED_AT)

    @cached_property
    def dim_customers(self) -> DataFrame:
        return conform(self.bronze_customers, CUSTOMERS, PROCESSED_AT, SALT)

    @cached_property
    def dim_products(self) -> DataFrame:
        return conform(self.bronze_products, PRODUCTS, PROCESSED_AT, SALT)


# --- the same in SQL -------------------------------------------------------------

_ORDER_COLUMNS = """
    CASE WHEN o_totalprice < 2000 THEN '  ' ELSE CAST(o_orderkey AS VARCHAR) END AS order_id,
    CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '5-LOW' THEN NULL
         ELSE CAST(o_custkey AS VARCHAR) END AS customer_id,
    CASE WHEN o_totalprice BETWEEN 490000 AND 495000 THEN strftime(o_orderdate, '%d/%m/%Y')
         ELSE strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') END AS order_date,
    CASE WHEN o_totalprice > 495000 THEN NULL ELSE o_totalprice END AS total_amount"""

SQL_MESSAGES = f"""
messages AS (
  SELECT {_ORDER_COLUMNS},
    o_orderstatus AS status, o_orderpriority AS payment_method
  FROM orders
)"""

SQL_DELIVERIES = f"""
delivered AS (
  SELECT o.*, CASE WHEN o_orderstatus = 'F' THEN 'O' ELSE o_orderstatus END AS status,
    TIMESTAMP '2002-01-01 00:00:00' AS _ingestion_timestamp
  FROM orders o
  UNION ALL
  SELECT o.*, 'F', TIMESTAMP '2002-01-01 01:00:00' FROM orders o WHERE o_orderstatus = 'F'
), named AS (
  SELECT o_orderkey, {_ORDER_COLUMNS},
    status, o_orderpriority AS payment_method, _ingestion_timestamp
  FROM delivered
), bronze AS (
  SELECT *,
    concat_ws(',',
      CASE WHEN order_id IS NULL OR trim(order_id) = '' THEN 'missing_order_id' END,
      CASE WHEN customer_id IS NULL OR trim(customer_id) = '' THEN 'missing_customer_id' END,
      CASE WHEN order_date IS NULL OR trim(order_date) = '' THEN 'missing_order_date' END,
      CASE WHEN total_amount IS NULL THEN 'missing_total_amount' END) AS _validation_errors,
    CASE WHEN trim(coalesce(order_id, '')) = '' OR trim(coalesce(customer_id, '')) = ''
           OR trim(coalesce(order_date, '')) = '' OR total_amount IS NULL
         THEN 'invalid' ELSE 'valid' END AS _record_status
  FROM named
)"""

SQL_FACT = f"""{SQL_DELIVERIES}, fact AS (
  SELECT order_id, customer_id, TRY_CAST(order_date AS TIMESTAMP) AS order_date, total_amount,
    status, payment_method, CAST(NULL AS VARCHAR) AS shipping_address_id,
    _ingestion_timestamp, TIMESTAMP '2002-01-02 00:00:00' AS _silver_processed_at
  FROM bronze
  WHERE _record_status = 'valid' AND TRY_CAST(order_date AS TIMESTAMP) IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY _ingestion_timestamp DESC) = 1
)"""

SQL_CUSTOMERS = """
all_customers AS (
  SELECT CAST(c_custkey AS VARCHAR) AS customer_id,
    CASE WHEN c_acctbal < 0 THEN NULL ELSE lower(c_name) || '@example.com' END AS email,
    c_name AS name, c_mktsegment AS city, n_name AS state, r_name AS country,
    CAST(DATE '1994-01-01' + CAST(c_nationkey * 10 AS INTEGER) AS TIMESTAMP) AS created_at,
    CAST(DATE '1994-01-01' + CAST(c_nationkey * 10 + 30 AS INTEGER) AS TIMESTAMP) AS updated_at
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
), dim_customers AS (
  SELECT customer_id, name, email, CAST(NULL AS VARCHAR) AS phone, CAST(NULL AS VARCHAR) AS address,
    city, state, country, CAST(NULL AS VARCHAR) AS postal_code, created_at, updated_at,
    sha256(concat_ws('|', 'not-a-secret', email)) AS email_salt_key,
    sha256(concat_ws('|', 'not-a-secret', '')) AS phone_salt_key,
    sha256(concat_ws('|', 'not-a-secret', name)) AS name_salt_key,
    TIMESTAMP '2002-01-01 00:00:00' AS _ingestion_timestamp,
    TIMESTAMP '2002-01-02 00:00:00' AS _silver_processed_at
  FROM all_customers WHERE email IS NOT NULL
)"""

SQL_PRODUCTS = """
dim_products AS (
  SELECT CAST(p_partkey AS VARCHAR) AS product_id, p_name AS name, p_type AS category,
    p_retailprice AS price, CAST(NULL AS VARCHAR) AS description, p_brand AS brand,
    CAST(NULL AS VARCHAR) AS sku, CAST(p_size AS DOUBLE) AS weight,
    TIMESTAMP '1994-01-01 00:00:00' AS created_at, TIMESTAMP '1994-02-01 00:00:00' AS updated_at,
    sha256(concat_ws('|', 'not-a-secret', p_name)) AS name_salt_key,
    TIMESTAMP '2002-01-01 00:00:00' AS _ingestion_timestamp,
    TIMESTAMP '2002-01-02 00:00:00' AS _silver_processed_at
  FROM part WHERE p_size < 50
)"""
