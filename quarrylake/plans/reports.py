"""Reports over gold, bronze status, job runs and usage records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def daily_order_summary(orders: DataFrame) -> DataFrame:
    return orders.groupBy(F.to_date("order_date").alias("order_date")).agg(
        F.count("*").alias("order_count"),
        F.sum("total_amount").alias("daily_revenue"),
        F.count_distinct("customer_id").alias("unique_customers"),
    )


def daily_revenue_trend(orders: DataFrame) -> DataFrame:
    trend = orders.groupBy(F.to_date("order_date").alias("date")).agg(
        F.sum("total_amount").alias("revenue"),
        F.count_distinct("order_id").alias("orders"),
    )
    return trend.orderBy("date")


def top_rows(df: DataFrame, by: str, key: str, n: int = 10) -> DataFrame:
    """The ``n`` rows greatest in ``by``; ties go to the smaller key."""
    return df.orderBy(F.desc_nulls_last(by), F.asc(key)).limit(n)


def status_breakdown(bronze: DataFrame) -> DataFrame:
    return bronze.groupBy("_record_status").agg(F.count("*").alias("records"))


def run_health(runs: DataFrame) -> DataFrame:
    """Runs per day and layer: outcomes, mean duration, records."""
    seconds = F.timestamp_diff("SECOND", F.col("start_time"), F.col("end_time"))
    health = runs.groupBy(F.to_date("start_time").alias("run_date"), "layer").agg(
        F.count("*").alias("total_runs"),
        F.count_if(F.col("status") == "success").alias("successful"),
        F.count_if(F.col("status") == "failed").alias("failed"),
        F.avg(seconds).alias("avg_duration_seconds"),
        F.sum("records_written").alias("total_records_processed"),
    )
    return health.orderBy(F.desc("run_date"), "layer")


def recent_runs(runs: DataFrame, n: int = 20) -> DataFrame:
    return runs.orderBy(F.desc("start_time"), F.asc("run_id")).limit(n)


def trailing_days(usage: DataFrame, column: str, today: str, days: int) -> DataFrame:
    """Rows of the last ``days`` days up to ``today``."""
    return usage.where(F.col(column) >= F.date_sub(F.lit(today).cast("date"), days))


def usage_by(usage: DataFrame, columns: list[str]) -> DataFrame:
    total = F.sum("usage_quantity").alias("total_units")
    return usage.groupBy(*columns).agg(total)


def cost_by(usage: DataFrame, columns: list[str], rate: float = 0.07) -> DataFrame:
    """Units and estimated cost per group; rows without a group are left out."""
    known = usage
    for name in columns:
        known = known.where(F.col(name).isNotNull())
    return known.groupBy(*columns).agg(
        F.sum("usage_quantity").alias("total_units"),
        F.sum(F.col("usage_quantity") * F.lit(rate)).alias("estimated_cost"),
    )


def group_by_pattern(name: str, patterns: dict[str, str], default: str = "Other") -> Column:
    """The label of the first LIKE pattern that the text matches."""
    label = None
    for text, pattern in patterns.items():
        hit = F.col(name).like(pattern)
        label = F.when(hit, text) if label is None else label.when(hit, text)
    return label.otherwise(default)


def daily_totals(df: DataFrame, time: str, amount: str, by: list[str]) -> DataFrame:
    return df.groupBy(*by, F.to_date(time).alias("day")).agg(
        F.sum(amount).alias("amount")
    )


def month_to_date(daily: DataFrame, by: list[str]) -> DataFrame:
    """Running total within the month; a window never holds more than 31 rows."""
    month = Window.partitionBy(*by, F.trunc("day", "month")).orderBy("day")
    running = F.sum("amount").over(month)
    return daily.select(*by, "day", "amount", running.alias("month_to_date"))


def spend_spikes(daily: DataFrame, by: list[str], days: int = 7, factor: float = 2.0) -> DataFrame:
    """Days above ``factor`` times the mean of the ``days`` days before.

    Days without a row count as 0. Each day adds its amount to the days after it,
    so a plain grouped sum gives the trailing sums and no single task sees the
    whole axis. Days with no day before them have no mean and are not flagged.
    """
    limits = daily.groupBy(*by).agg(F.min("day").alias("_first"), F.max("day").alias("_last"))
    axis = limits.select(*by, "_first", F.explode(F.sequence("_first", "_last")).alias("day"))
    own = daily.select(*by, "day", F.col("amount"), F.lit(None).cast("double").alias("_earlier"))
    later = daily.select(
        *by,
        F.explode(F.sequence(F.date_add("day", 1), F.date_add("day", days))).alias("day"),
        F.lit(None).cast("double").alias("amount"),
        F.col("amount").alias("_earlier"),
    )
    sums = own.unionByName(later).groupBy(*by, "day").agg(
        F.sum("amount").alias("_amount"), F.sum("_earlier").alias("_sum")
    )
    past = F.least(F.lit(days), F.datediff("day", "_first"))
    amount = F.coalesce("_amount", F.lit(0.0))
    mean = F.try_divide(F.coalesce("_sum", F.lit(0.0)), past)
    return axis.join(sums, [*by, "day"], "left").select(
        *by,
        "day",
        amount.alias("amount"),
        mean.alias("trailing_mean"),
        F.coalesce(amount > mean * F.lit(factor), F.lit(False)).alias("is_spike"),
    )

