"""The business views: order summary, customer lifetime value, product sales."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarrylake.operators.latest import keep_latest
from quarrylake.operators.quality_rules import VALID


def order_summary(fact_orders: DataFrame, dim_customers: DataFrame) -> DataFrame:
    """One row per order with its customer; ``customer_id`` is the customer side's.

    Facts that are stored by day keep their day, so that a date range reads its days only.
    """
    day = [name for name in ("order_day",) if name in fact_orders.columns]
    customer = dim_customers.select(
        F.col("customer_id").alias("_ref"),
        "customer_id",
        F.col("name").alias("customer_name"),
        "email_salt_key",
        F.col("city").alias("customer_city"),
        F.col("state").alias("customer_state"),
        F.col("country").alias("customer_country"),
    )
    order = fact_orders.withColumnRenamed("customer_id", "_buyer")
    return order.join(customer, F.col("_buyer") == F.col("_ref"), "left").select(
        "order_id",
        "order_date",
        "total_amount",
        F.col("status").alias("order_status"),
        "payment_method",
        "customer_id",
        "customer_name",
        "email_salt_key",
        "customer_city",
        "customer_state",
        "customer_country",
        "_silver_processed_at",
        *day,
    )


def customer_lifetime_value(dim_customers: DataFrame, fact_orders: DataFrame) -> DataFrame:
    """Spend per customer; customers without orders stay, with 0 orders.

    Orders are reduced to one row per customer before the join, so the join moves
    one row per customer and a customer with very many orders is no hot key. The
    dimension holds each ``customer_id`` once.
    """
    spend = fact_orders.groupBy("customer_id").agg(
        F.count_distinct("order_id").alias("total_orders"),
        F.sum("total_amount").alias("total_spend"),
        F.avg("total_amount").alias("avg_order_value"),
        F.min("order_date").alias("first_order_date"),
        F.max("order_date").alias("last_order_date"),
    )
    return dim_customers.join(spend, "customer_id", "left").select(
        "customer_id",
        F.col("name").alias("customer_name"),
        "email_salt_key",
        "city",
        "state",
        "country",
        F.col("created_at").alias("customer_since"),
        F.coalesce("total_orders", F.lit(0)).alias("total_orders"),
        "total_spend",
        "avg_order_value",
        "first_order_date",
        "last_order_date",
        F.datediff("last_order_date", "first_order_date").alias("customer_tenure_days"),
    )


def order_items(bronze_orders: DataFrame) -> DataFrame:
    """One row per item of the valid orders; orders without items give none."""
    item = F.col("_item")
    return (
        bronze_orders.where(F.col("_record_status") == VALID)
        .select("order_id", "order_date", F.explode("items").alias("_item"))
        .select(
            "order_id",
            "order_date",
            item.product_id.alias("product_id"),
            item.quantity.alias("quantity"),
            item.unit_price.alias("unit_price"),
            (item.quantity * item.unit_price).alias("line_total"),
        )
    )


def product_sales(dim_products: DataFrame, bronze_orders: DataFrame) -> DataFrame:
    """Sales per product; products without sales stay, with 0 sales and revenue.

    Reads bronze as it is: a redelivered order counts again in the revenue, but not
    in ``times_ordered``. ``order_date`` is still a text here. Items are reduced to
    one row per product before the join.
    """
    sales = order_items(bronze_orders).groupBy("product_id").agg(
        F.count_distinct("order_id").alias("times_ordered"),
        F.sum("line_total").alias("total_revenue"),
        F.avg("line_total").alias("avg_line_value"),
        F.min("order_date").alias("first_sale_date"),
        F.max("order_date").alias("last_sale_date"),
    )
    return dim_products.join(sales, "product_id", "left").select(
        "product_id",
        F.col("name").alias("product_name"),
        "category",
        "brand",
        F.col("price").alias("current_price"),
        "name_salt_key",
        F.coalesce("times_ordered", F.lit(0)).alias("times_ordered"),
        F.coalesce("total_revenue", F.lit(0.0)).alias("total_revenue"),
        "avg_line_value",
        "first_sale_date",
        "last_sale_date",
    )


def product_sales_dedup(dim_products: DataFrame, bronze_orders: DataFrame) -> DataFrame:
    """Product sales over one delivery of each order only: the last one, also of those in one batch."""
    valid = bronze_orders.where(F.col("_record_status") == VALID)
    return product_sales(dim_products, keep_latest(valid, ["order_id"], ["_ingestion_timestamp"]))


def create_gold_views(
    spark: SparkSession,
    fact_orders: DataFrame,
    dim_customers: DataFrame,
    dim_products: DataFrame,
    bronze_orders: DataFrame,
) -> dict[str, DataFrame]:
    """Register the three views; nothing runs until one is read."""
    views = {
        "vw_order_summary": order_summary(fact_orders, dim_customers),
        "vw_customer_lifetime_value": customer_lifetime_value(dim_customers, fact_orders),
        "vw_product_sales": product_sales(dim_products, bronze_orders),
    }
    for name, view in views.items():
        view.createOrReplaceTempView(name)
    return views


def materialize(view: DataFrame, path: str) -> None:
    """Store a view's result for readers that need it fast."""
    view.write.mode("overwrite").parquet(path)


def in_date_range(df: DataFrame, column: str, first: str, last: str, day: str | None = None) -> DataFrame:
    """Rows with ``first <= column <= last``.

    A range on a time says nothing to Spark about the folders of the days the rows are stored by.
    With ``day``, the column that holds the date of ``column``, the range of days that follows from
    it is asked for too and prunes the folders. Rows without a time are in no range.
    """
    low, high = F.lit(first), F.lit(last)
    inside = F.col(column).between(low, high)
    if day:
        days = [bound.cast("timestamp").cast("date") for bound in (low, high)]
        inside = inside & F.col(day).between(*days)
    return df.where(inside)
