"""Reports: daily figures, top lists, run health, usage and cost."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarrylake.operators.checks import volume_changes, volume_results
from quarrylake.plans import gold, reports
from quarrylake.queries import query
from quarrylake.queries.inputs import PROCESSED_AT, SQL_CUSTOMERS, SQL_FACT, Inputs

LAST_DAY = "2024-01-30"


@query(f"""
WITH {SQL_FACT}
SELECT CAST(order_date AS DATE) AS order_date, count(*) AS order_count,
  sum(total_amount) AS daily_revenue, count(DISTINCT customer_id) AS unique_customers
FROM fact GROUP BY 1
""", rounded=("daily_revenue",))
def daily_order_summary(inputs: Inputs) -> DataFrame:
    return reports.daily_order_summary(inputs.fact_orders)


@query(f"""
WITH {SQL_FACT}
SELECT CAST(order_date AS DATE) AS date, sum(total_amount) AS revenue,
  count(DISTINCT order_id) AS orders
FROM fact GROUP BY 1 ORDER BY 1
""", rounded=("revenue",))
def daily_revenue_trend(inputs: Inputs) -> DataFrame:
    return reports.daily_revenue_trend(inputs.fact_orders)


@query(f"""
WITH {SQL_FACT}
SELECT DISTINCT CAST(order_date AS DATE) AS partition_date FROM fact ORDER BY 1
""")
def partition_dates(inputs: Inputs) -> DataFrame:
    days = inputs.fact_orders.select(F.to_date("order_date").alias("partition_date"))
    return days.distinct().orderBy("partition_date")


@query(f"""
WITH {SQL_FACT}, {SQL_CUSTOMERS}
SELECT c.customer_id, c.name AS customer_name, count(DISTINCT o.order_id) AS total_orders,
  sum(o.total_amount) AS total_spend
FROM dim_customers c LEFT JOIN fact o ON c.customer_id = o.customer_id
GROUP BY c.customer_id, c.name ORDER BY total_spend DESC NULLS LAST, c.customer_id LIMIT 10
""", rounded=("total_spend",))
def top_customers(inputs: Inputs) -> DataFrame:
    value = gold.customer_lifetime_value(inputs.dim_customers, inputs.fact_orders)
    top = reports.top_rows(value, "total_spend", "customer_id", 10)
    return top.select("customer_id", "customer_name", "total_orders", "total_spend")


@query(f"""
WITH sold AS (
  SELECT CAST(l_partkey AS VARCHAR) AS product_id, o_orderkey,
    CAST(l_quantity AS INTEGER) * (l_extendedprice / l_quantity) AS line_total,
    CASE WHEN o_orderstatus = 'F' THEN 2 ELSE 1 END AS deliveries
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  WHERE o_totalprice BETWEEN 2000 AND 495000 AND NOT (o_orderstatus = 'P' AND o_orderpriority = '5-LOW')
)
SELECT CAST(p_partkey AS VARCHAR) AS product_id, p_name AS product_name,
  coalesce(sum(deliveries * line_total), 0) AS total_revenue
FROM part LEFT JOIN sold ON product_id = CAST(p_partkey AS VARCHAR)
WHERE p_size < 50
GROUP BY p_partkey, p_name ORDER BY total_revenue DESC, CAST(p_partkey AS VARCHAR) LIMIT 10
""", rounded=("total_revenue",))
def top_products(inputs: Inputs) -> DataFrame:
    sales = gold.product_sales(inputs.dim_products, inputs.bronze_orders_with_items)
    top = reports.top_rows(sales, "total_revenue", "product_id", 10)
    return top.select("product_id", "product_name", "total_revenue")


def _runs(inputs: Inputs) -> DataFrame:
    """Each event as a job run: its value is the duration, an error a failed run."""
    seconds = F.floor("value").cast("bigint")
    start = F.col("ts").cast("timestamp")
    return inputs.table("events").select(
        F.col("event_id").cast("string").alias("run_id"),
        F.concat(F.lit("topic-"), (F.length("props")).cast("string")).alias("topic_name"),
        F.col("event_type").alias("layer"),
        start.alias("start_time"),
        F.timestamp_micros(F.unix_micros(start) + seconds * 1000000).alias("end_time"),
        F.when(F.col("event_type") == "error", "failed").otherwise("success").alias("status"),
        F.col("user_id").alias("records_written"),
    )


_RUNS = """
runs AS (
  SELECT CAST(event_id AS VARCHAR) AS run_id, 'topic-' || length(props) AS topic_name,
    event_type AS layer, ts AS start_time, CAST(floor(value) AS BIGINT) AS seconds,
    CASE WHEN event_type = 'error' THEN 'failed' ELSE 'success' END AS status,
    user_id AS records_written
  FROM events
)"""


@query(f"""
WITH {_RUNS}
SELECT CAST(start_time AS DATE) AS run_date, layer, count(*) AS total_runs,
  count(CASE WHEN status = 'success' THEN 1 END) AS successful,
  count(CASE WHEN status = 'failed' THEN 1 END) AS failed,
  avg(seconds) AS avg_duration_seconds, CAST(sum(records_written) AS BIGINT) AS total_records_processed
FROM runs GROUP BY 1, 2 ORDER BY 1 DESC, 2
""")
def run_health(inputs: Inputs) -> DataFrame:
    return reports.run_health(_runs(inputs))


@query(f"""
WITH {_RUNS}
SELECT run_id, layer, start_time, status FROM runs ORDER BY start_time DESC, run_id LIMIT 20
""")
def recent_runs(inputs: Inputs) -> DataFrame:
    return reports.recent_runs(_runs(inputs), 20).select("run_id", "layer", "start_time", "status")


@query(f"""
WITH {_RUNS}, paired AS (
  SELECT run_id, topic_name, layer, start_time, records_written, lag(records_written) OVER
      (PARTITION BY topic_name, layer ORDER BY start_time, run_id) AS previous_records
  FROM runs
)
SELECT *, CASE WHEN previous_records IS NULL THEN 'first'
  WHEN abs(records_written - previous_records) <= previous_records * CAST(0.2 AS DOUBLE) THEN 'pass'
  ELSE 'warn' END AS check_result
FROM paired
""")
def volume_check(inputs: Inputs) -> DataFrame:
    return volume_changes(_runs(inputs), 0.2)


@query(f"""
WITH {_RUNS}, paired AS (
  SELECT run_id, topic_name, layer, records_written, lag(run_id) OVER w AS previous_run,
    lag(records_written) OVER w AS previous_records
  FROM runs WINDOW w AS (PARTITION BY topic_name, layer ORDER BY start_time, run_id)
)
SELECT layer || '.' || topic_name || '.volume.' || run_id AS check_id, 'run-1' AS run_id,
  layer || '.' || topic_name AS table_name, 'volume' AS check_type,
  'rows written against the run before' AS check_description,
  CASE WHEN abs(records_written - previous_records) <= previous_records * CAST(0.2 AS DOUBLE) THEN 'pass' ELSE 'warn' END
    AS check_result,
  CAST(previous_records AS VARCHAR) AS expected_value, CAST(records_written AS VARCHAR) AS actual_value,
  CAST(0.2 AS DOUBLE) AS threshold, TIMESTAMP '2002-01-02' AS checked_at
FROM paired WHERE previous_records IS NOT NULL
""")
def volume_in_results(inputs: Inputs) -> DataFrame:
    """The volume check as rows of the common result table."""
    return volume_results(_runs(inputs), "run-1", PROCESSED_AT)


def _usage(inputs: Inputs) -> DataFrame:
    return inputs.table("events").select(
        F.to_date("ts").alias("usage_date"),
        F.concat(F.lit("daily "), F.col("event_type"), F.lit(" job")).alias("job_name"),
        F.when(F.col("event_type") != "view", F.col("user_id").cast("string")).alias("job_id"),
        F.col("event_type").alias("sku_name"),
        F.col("value").alias("usage_quantity"),
    )


_USAGE = """
usage AS (
  SELECT CAST(ts AS DATE) AS usage_date, 'daily ' || event_type || ' job' AS job_name,
    CASE WHEN event_type <> 'view' THEN CAST(user_id AS VARCHAR) END AS job_id,
    event_type AS sku_name, value AS usage_quantity
  FROM events
)"""


@query(f"""
WITH {_USAGE}
SELECT usage_date, sku_name, sum(usage_quantity) AS total_units FROM usage
WHERE usage_date >= DATE '{LAST_DAY}' - 20 GROUP BY usage_date, sku_name
""", rounded=("total_units",))
def usage_trailing_days(inputs: Inputs) -> DataFrame:
    recent = reports.trailing_days(_usage(inputs), "usage_date", LAST_DAY, 20)
    return reports.usage_by(recent, ["usage_date", "sku_name"])


@query(f"""
WITH {_USAGE}
SELECT CASE WHEN job_name LIKE '%click%' THEN 'Bronze' WHEN job_name LIKE '%view%' THEN 'Silver'
    WHEN job_name LIKE '%purchase%' THEN 'Gold' ELSE 'Other' END AS layer,
  sum(usage_quantity) AS total_units,
  sum(usage_quantity * CAST(0.07 AS DOUBLE)) AS estimated_cost
FROM usage GROUP BY 1
""", rounded=("total_units", "estimated_cost"))
def cost_by_layer(inputs: Inputs) -> DataFrame:
    patterns = {"Bronze": "%click%", "Silver": "%view%", "Gold": "%purchase%"}
    layered = _usage(inputs).withColumn("layer", reports.group_by_pattern("job_name", patterns))
    return reports.cost_by(layered, ["layer"])


@query(f"""
WITH {_USAGE}
SELECT job_id, job_name, sum(usage_quantity) AS total_units,
  sum(usage_quantity * CAST(0.07 AS DOUBLE)) AS estimated_cost
FROM usage WHERE job_id IS NOT NULL GROUP BY job_id, job_name
""", rounded=("total_units", "estimated_cost"))
def cost_per_job(inputs: Inputs) -> DataFrame:
    return reports.cost_by(_usage(inputs), ["job_id", "job_name"])


@query(f"""
WITH {_USAGE}
SELECT job_id, job_name, sum(usage_quantity) AS total_units
FROM usage WHERE job_id IS NOT NULL GROUP BY job_id, job_name
ORDER BY total_units DESC, concat_ws('/', job_id, job_name) LIMIT 5
""", rounded=("total_units",))
def top_jobs(inputs: Inputs) -> DataFrame:
    cost = reports.cost_by(_usage(inputs), ["job_id", "job_name"])
    keyed = cost.withColumn("_key", F.concat_ws("/", "job_id", "job_name"))
    return reports.top_rows(keyed, "total_units", "_key", 5).select("job_id", "job_name", "total_units")


_DAILY = f"""
daily AS (
  SELECT event_type, CAST(ts AS DATE) AS day, sum(value) AS amount
  FROM events GROUP BY 1, 2
)"""


def _daily(inputs: Inputs) -> DataFrame:
    return reports.daily_totals(inputs.table("events"), "ts", "value", ["event_type"])


@query(f"""
WITH {_DAILY}
SELECT event_type, day, amount, sum(amount) OVER
    (PARTITION BY event_type, date_trunc('month', day) ORDER BY day) AS month_to_date
FROM daily
""", rounded=("amount", "month_to_date"))
def month_to_date(inputs: Inputs) -> DataFrame:
    return reports.month_to_date(_daily(inputs), ["event_type"])


_LARGE_DAILY = f"""
daily AS (
  SELECT o_orderstatus, CAST(o_orderdate AS DATE) AS day, sum(o_totalprice) AS amount
  FROM orders GROUP BY 1, 2
), axis AS (
  SELECT o_orderstatus, CAST(unnest(generate_series(min(day), max(day), INTERVAL 1 DAY)) AS DATE) AS day
  FROM daily GROUP BY o_orderstatus
), filled AS (
  SELECT a.o_orderstatus, a.day, coalesce(d.amount, 0) AS amount
  FROM axis a LEFT JOIN daily d ON a.o_orderstatus = d.o_orderstatus AND a.day = d.day
), means AS (
  SELECT *, sum(amount) OVER w / count(*) OVER w AS trailing_mean
  FROM filled
  WINDOW w AS (PARTITION BY o_orderstatus ORDER BY day ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING)
)"""


@query(f"""
WITH {_LARGE_DAILY}
SELECT o_orderstatus, day, amount, trailing_mean, coalesce(amount > trailing_mean * 2, false) AS is_spike
FROM means
""", rounded=("amount", "trailing_mean"))
def spend_spikes(inputs: Inputs) -> DataFrame:
    daily = reports.daily_totals(inputs.table("orders"), "o_orderdate", "o_totalprice", ["o_orderstatus"])
    return reports.spend_spikes(daily, ["o_orderstatus"])
