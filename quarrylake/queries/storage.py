"""Streams, tables and file layout: what is written must read back the same."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarrylake.operators.reshape import group_columns, split_columns
from quarrylake.operators.upsert import update_columns
from quarrylake.plans import gold
from quarrylake.plans.run_log import read_runs
from quarrylake.plans.silver import conform
from quarrylake.queries import query
from quarrylake.queries.changes import _DISCOUNTS, _discounts
from quarrylake.queries.layers import _summary_sql
from quarrylake.queries.inputs import (
    FIRST_DELIVERY,
    PROCESSED_AT,
    SALT,
    SQL_CUSTOMERS,
    SQL_FACT,
    SQL_MESSAGES,
    SQL_PRODUCTS,
    Inputs,
    stamp,
)
from quarrylake.schemas import CUSTOMERS, ORDERS, PRODUCTS, ddl
from quarrylake.sources import layout
from quarrylake.sources.landing import read_landing_hours, write_landing
from quarrylake.sources.tables import PartitionedTable, VersionedTable, folder_sizes, table_files
from quarrylake.streaming.bronze import BronzeTable, bulk_load, ingest
from quarrylake.streaming.silver import SilverTable, refresh, since, stream_to_silver
from quarrylake.workspace import new_folder


_DAY = "CAST({} AS DATE) AS order_day"


def _land(folder: str, rows: DataFrame, key: str) -> None:
    """Messages arrive hour by hour over two days, dealt by key; those without a readable key first."""
    hour = F.coalesce(F.col(key).try_cast("bigint") % 48, F.lit(0))
    write_landing(rows, folder, stamp(FIRST_DELIVERY) + F.make_dt_interval(hours=hour.cast("int")))


def _ingested(inputs: Inputs, topic=ORDERS, messages: DataFrame | None = None, run_log: str | None = None) -> tuple[BronzeTable, str]:
    base = new_folder(inputs.spark, topic.name)
    messages = inputs.order_messages_with_items() if messages is None else messages
    _land(f"{base}/landing", messages, topic.key)
    third = inputs.table("orders").count() // 3 + 1  # a batch of orders lies in several files
    bronze = BronzeTable(inputs.spark, f"{base}/bronze", topic, third)
    ingest(bronze, f"{base}/landing", f"{base}/bronze_checkpoint", run_log=run_log).awaitTermination()
    return bronze, base


_STATUS = """CASE WHEN trim(order_id) = '' OR customer_id IS NULL OR total_amount IS NULL
  THEN 'invalid' ELSE 'valid' END"""
_READABLE = "TRY_CAST(order_date AS TIMESTAMP) IS NOT NULL"


@query(f"""
WITH {SQL_MESSAGES}
SELECT {_STATUS} AS _record_status, count(*) AS records FROM messages GROUP BY 1
""")
def bronze_stream_counts(inputs: Inputs) -> DataFrame:
    bronze, _ = _ingested(inputs)
    return bronze.read().groupBy("_record_status").agg(F.count("*").alias("records"))


@query(f"""
SELECT CAST(l_partkey AS VARCHAR) AS product_id, count(*) AS lines, CAST(sum(l_quantity) AS BIGINT) AS quantity
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
WHERE o_totalprice >= 2000 AND o_totalprice <= 495000
  AND NOT (o_orderstatus = 'P' AND o_orderpriority = '5-LOW')
GROUP BY l_partkey
""")
def bronze_items_from_stream(inputs: Inputs) -> DataFrame:
    """Items of the valid orders after landing and stream."""
    bronze, _ = _ingested(inputs)
    items = gold.order_items(bronze.read())
    return items.groupBy("product_id").agg(F.count("*").alias("lines"), F.sum("quantity").alias("quantity"))


@query(f"""
WITH {SQL_MESSAGES}
SELECT order_id, {_STATUS} AS _record_status FROM messages
""")
def bulk_loaded_orders(inputs: Inputs) -> DataFrame:
    """The same files as one batch job."""
    base = new_folder(inputs.spark, "history")
    _land(f"{base}/landing", inputs.order_messages_with_items(), "order_id")
    bronze = BronzeTable(inputs.spark, f"{base}/bronze", ORDERS)
    bulk_load(bronze, f"{base}/landing", "history-1")
    return bronze.read().select("order_id", "_record_status")


_SILVER_ROWS = f"""
WITH {SQL_MESSAGES}
SELECT order_id, customer_id, TRY_CAST(order_date AS TIMESTAMP) AS order_date, total_amount, status,
  {_DAY.format("TRY_CAST(order_date AS TIMESTAMP)")}
FROM messages WHERE {_STATUS} = 'valid' AND {_READABLE}
"""
_SILVER_COLUMNS = ["order_id", "customer_id", "order_date", "total_amount", "status", "order_day"]


@query(_SILVER_ROWS)
def silver_from_new_batches(inputs: Inputs) -> DataFrame:
    """Landing to bronze to silver, by high-water mark, in two rounds of arrivals."""
    base, orders = new_folder(inputs.spark, "orders"), inputs.order_messages_with_items()
    bronze = BronzeTable(inputs.spark, f"{base}/bronze", ORDERS)
    silver = SilverTable(inputs.spark, f"{base}/fact_orders", ORDERS)
    finished = F.col("status") == "F"
    for name, arrived in (("first", orders.where(~finished)), ("second", orders.where(finished))):
        _land(f"{base}/{name}", arrived, "order_id")
        ingest(bronze, f"{base}/{name}", f"{base}/{name}_checkpoint").awaitTermination()
        refresh(bronze, silver)
    return silver.read().select(*_SILVER_COLUMNS)


def _streamed(inputs: Inputs, run_log: str | None = None) -> tuple[SilverTable, BronzeTable]:
    bronze, base = _ingested(inputs, run_log=run_log)
    silver = SilverTable(inputs.spark, f"{base}/fact_orders", ORDERS)
    stream_to_silver(bronze, silver, f"{base}/silver_checkpoint", run_log=run_log, max_files=2).awaitTermination()
    silver.settle()
    return silver, bronze


@query(_SILVER_ROWS)
def silver_from_stream(inputs: Inputs) -> DataFrame:
    """Landing to bronze to silver, both as streams; a bronze batch comes in several parts."""
    return _streamed(inputs)[0].read().select(*_SILVER_COLUMNS)


@query(f"""
WITH {SQL_MESSAGES}
SELECT order_id, order_date, CASE WHEN {_READABLE} THEN 'silver' ELSE 'rejects' END AS kept_in
FROM messages WHERE {_STATUS} = 'valid'
""")
def silver_rejects_from_stream(inputs: Inputs) -> DataFrame:
    """Every valid bronze row is in silver or in the rejects, also if its batch came in several parts."""
    silver, bronze = _streamed(inputs)
    text = F.date_format("order_date", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("order_date")
    kept = silver.read().select("order_id", text, F.lit("silver").alias("kept_in"))
    return kept.unionByName(silver.rejects(bronze).select("order_id", "order_date", F.lit("rejects").alias("kept_in")))


@query(f"""
WITH {SQL_MESSAGES}, counted AS (
  SELECT count(*) AS arrived, count(*) FILTER ({_STATUS} = 'valid') AS valid,
    count(*) FILTER ({_STATUS} = 'valid' AND {_READABLE}) AS typed FROM messages)
SELECT 'orders' AS topic_name, 'bronze' AS layer, 'ingest' AS job_name, 'success' AS status,
  arrived AS records_read, valid AS records_written, arrived - valid AS records_invalid FROM counted
UNION ALL SELECT 'orders', 'silver', 'stream', 'success', valid, typed, valid - typed FROM counted
UNION ALL SELECT 'orders', 'silver', 'refresh', 'success', valid, typed, valid - typed FROM counted
UNION ALL
SELECT 'customers', 'bronze', 'ingest', 'success', count(*), count(*) FILTER (c_acctbal >= 0), count(*) FILTER (c_acctbal < 0)
FROM customer
UNION ALL SELECT 'customers', 'silver', 'refresh', 'failed', 0, 0, 0
""")
def silver_run_log(inputs: Inputs) -> DataFrame:
    """What the runs of two topics logged; the customers lack a salt, so their run fails."""
    log = new_folder(inputs.spark, "runs")
    _, bronze = _streamed(inputs, log)
    again = SilverTable(inputs.spark, new_folder(inputs.spark, "fact_orders"), ORDERS)
    for _ in range(2):  # the second time there is nothing new, and nothing is logged
        refresh(bronze, again, run_log=log)
    customers, base = _ingested(inputs, CUSTOMERS, inputs.customer_messages(), log)
    try:
        refresh(customers, SilverTable(inputs.spark, f"{base}/dim_customers", CUSTOMERS), run_log=log)
    except ValueError:
        pass  # it is in the log
    counts = [F.sum(name).alias(name) for name in ("records_read", "records_written", "records_invalid")]
    return read_runs(inputs.spark, log).groupBy("topic_name", "layer", "job_name", "status").agg(*counts)


_NO_TIMES = "* EXCLUDE (_ingestion_timestamp, _silver_processed_at)"


def _dimension(inputs: Inputs, topic, messages: DataFrame) -> DataFrame:
    """Landing to bronze to silver, in two rounds of arrivals."""
    base = new_folder(inputs.spark, topic.name)
    bronze = BronzeTable(inputs.spark, f"{base}/bronze", topic)
    silver = SilverTable(inputs.spark, f"{base}/silver", topic)
    odd = F.col(topic.key).cast("bigint") % 2 == 1
    for name, arrived in (("first", messages.withColumn("name", F.lit("old"))), ("second", messages.where(odd)), ("third", messages.where(~odd))):
        _land(f"{base}/{name}", arrived, topic.key)
        ingest(bronze, f"{base}/{name}", f"{base}/{name}_checkpoint").awaitTermination()
        refresh(bronze, silver, SALT)
    return silver.read().drop("_ingestion_timestamp", "_silver_processed_at")


@query(f"WITH {SQL_CUSTOMERS} SELECT {_NO_TIMES} FROM dim_customers")
def dim_customers_from_stream(inputs: Inputs) -> DataFrame:
    return _dimension(inputs, CUSTOMERS, inputs.customer_messages())


@query(f"WITH {SQL_PRODUCTS} SELECT {_NO_TIMES} FROM dim_products")
def dim_products_from_stream(inputs: Inputs) -> DataFrame:
    return _dimension(inputs, PRODUCTS, inputs.product_messages())


@query(f"""
WITH {SQL_MESSAGES}
SELECT CAST(year(arrival) AS INTEGER) AS year, CAST(month(arrival) AS INTEGER) AS month,
  CAST(day(arrival) AS INTEGER) AS day, CAST(hour(arrival) AS INTEGER) AS hour, count(*) AS records
FROM (SELECT TIMESTAMP '2002-01-01' + to_hours(CAST(coalesce(TRY_CAST(order_id AS BIGINT) % 48, 0) AS INTEGER)) AS arrival
  FROM messages)
GROUP BY ALL
""")
def landing_hours(inputs: Inputs) -> DataFrame:
    base = new_folder(inputs.spark, "landing")
    _land(base, inputs.order_messages_with_items(), "order_id")
    hours = read_landing_hours(inputs.spark, ORDERS, base)
    return hours.groupBy("year", "month", "day", "hour").agg(F.count("*").alias("records"))


def _fact_table(inputs: Inputs) -> PartitionedTable:
    """The first deliveries written by day, then the later ones merged in."""
    bronze = inputs.bronze_orders
    later = since(bronze, "_ingestion_timestamp", FIRST_DELIVERY)
    first = bronze.where(F.col("_ingestion_timestamp") <= stamp(FIRST_DELIVERY))
    schema = ddl({**ORDERS.silver, "_ingestion_timestamp": "timestamp", "_silver_processed_at": "timestamp", "order_day": "date"})
    table = PartitionedTable(inputs.spark, new_folder(inputs.spark, "fact_orders"), "order_day", schema)
    for part in (first, later):
        rows = conform(part, ORDERS, PROCESSED_AT).withColumn("order_day", F.to_date("order_date"))
        table.merge(rows, ["order_id"], "_ingestion_timestamp")
    return table


@query(f"WITH {SQL_FACT} SELECT *, {_DAY.format('order_date')} FROM fact")
def fact_orders_merged(inputs: Inputs) -> DataFrame:
    return _fact_table(inputs).read()


@query(f"""
WITH {SQL_FACT}, moved AS (
  SELECT * REPLACE (CASE WHEN status = 'P' THEN order_date + INTERVAL 40 DAY ELSE order_date END AS order_date,
    CASE WHEN status = 'P' THEN TIMESTAMP '2002-01-03' ELSE _ingestion_timestamp END AS _ingestion_timestamp)
  FROM fact)
SELECT order_id, order_date, status, _ingestion_timestamp, {_DAY.format('order_date')} FROM moved
""")
def fact_orders_moved(inputs: Inputs) -> DataFrame:
    """Open parts of orders move to a day 40 days later: no order is in two days."""
    table = _fact_table(inputs)
    late = F.col("order_date") + F.expr("INTERVAL 40 DAYS")
    moved = table.read().where("status = 'P'").withColumns(
        {"order_date": late, "order_day": late.cast("date"), "_ingestion_timestamp": F.lit("2002-01-03").cast("timestamp")}
    )
    table.merge(moved, ["order_id"], "_ingestion_timestamp")
    return table.read().select("order_id", "order_date", "status", "_ingestion_timestamp", "order_day")


@query(f"""
WITH {SQL_FACT}, {SQL_CUSTOMERS}
SELECT f.order_id, f.order_date, f.total_amount, c.customer_id, c.name AS customer_name, {_DAY.format("f.order_date")}
FROM fact f LEFT JOIN dim_customers c ON f.customer_id = c.customer_id
WHERE f.order_date BETWEEN TIMESTAMP '1997-02-01' AND TIMESTAMP '1997-03-15'
""")
def stored_orders_in_range(inputs: Inputs) -> DataFrame:
    """A range of the order summary over stored facts reads the folders of its days only."""
    summary = gold.order_summary(_fact_table(inputs).read(), inputs.dim_customers)
    chosen = gold.in_date_range(summary, "order_date", "1997-02-01", "1997-03-15", day="order_day")
    return chosen.select("order_id", "order_date", "total_amount", "customer_id", "customer_name", "order_day")


@query(f"WITH {SQL_FACT} SELECT *, {_DAY.format('order_date')} FROM fact")
def clustered_fact_orders(inputs: Inputs) -> DataFrame:
    """The facts after each day's files were rewritten in cluster order."""
    silver = SilverTable(inputs.spark, new_folder(inputs.spark, "fact_orders"), ORDERS)
    silver.merge(inputs.fact_orders)
    silver.optimize(files=8)
    return silver.read()


@query(f"""
WITH {SQL_CUSTOMERS}
SELECT * REPLACE (
  CASE WHEN state < 'NATION_2' THEN 'moved' ELSE city END AS city,
  _ingestion_timestamp + CASE WHEN state < 'NATION_2' THEN INTERVAL 1 HOUR ELSE INTERVAL 0 HOUR END
    AS _ingestion_timestamp)
FROM dim_customers
""")
def dim_customers_versioned(inputs: Inputs) -> DataFrame:
    """A second version of the table in which the customers of some nations moved."""
    rows = conform(inputs.bronze_customers, CUSTOMERS, PROCESSED_AT, SALT)
    table = VersionedTable(inputs.spark, new_folder(inputs.spark, "dim_customers"))
    table.merge(rows, ["customer_id"], "_ingestion_timestamp")
    moved = rows.where(F.col("state") < "NATION_2").withColumns(
        {
            "city": F.lit("moved"),
            "_ingestion_timestamp": F.col("_ingestion_timestamp") + F.expr("INTERVAL 1 HOUR"),
        }
    )
    table.merge(moved, ["customer_id"], "_ingestion_timestamp")
    return table.read()


@query(f"""
WITH {_DISCOUNTS}
SELECT o.o_orderkey, o.o_totalprice, CAST(o.o_orderdate AS DATE) AS order_day,
  d.discount_amount
FROM orders o LEFT JOIN discounts d ON o.o_orderkey = d.o_orderkey
""", rounded=("discount_amount",))
def backfill_by_partition(inputs: Inputs) -> DataFrame:
    """A new column filled one year's days at a time.

    The values are computed once and laid out by the same days, so that each
    step reads no more than its own part of them.
    """
    spark = inputs.spark
    orders = inputs.table("orders").select("o_orderkey", "o_totalprice", F.to_date("o_orderdate").alias("order_day"))
    added = "o_orderkey bigint, discount_amount double, order_day date"
    table = PartitionedTable(
        spark, new_folder(spark, "orders_by_day"), "order_day", f"o_totalprice double, {added}"
    )
    table.write(orders)
    values = PartitionedTable(spark, new_folder(spark, "discounts_by_day"), "order_day", added)
    values.write(
        _discounts(inputs).join(orders.select("o_orderkey", "order_day"), "o_orderkey")
    )
    days = [row[0] for row in table.partitions().collect()]
    for year in sorted({d.year for d in days}):
        chunk = [d for d in days if d.year == year]
        patch = values.read().where(F.col("order_day").between(chunk[0], chunk[-1])).drop("order_day")
        table.rewrite(
            chunk,
            lambda old, patch=patch: update_columns(old, patch, ["o_orderkey"], ["discount_amount"]),
        )
    return table.read()


@query(_summary_sql("true"))
def materialized_order_summary(inputs: Inputs) -> DataFrame:
    """A gold view stored as a table."""
    path = new_folder(inputs.spark, "order_summary")
    gold.materialize(gold.order_summary(inputs.fact_orders, inputs.dim_customers), path)
    return inputs.spark.read.parquet(path)


@query(f"WITH {SQL_CUSTOMERS} SELECT customer_id, city, state, email_salt_key FROM dim_customers")
def clustered_dim_customers(inputs: Inputs) -> DataFrame:
    """The customer dimension after its files were rewritten in cluster order."""
    silver = SilverTable(inputs.spark, new_folder(inputs.spark, "dim_customers"), CUSTOMERS)
    silver.merge(inputs.dim_customers)
    silver.optimize(files=4)
    return silver.read().select("customer_id", "city", "state", "email_salt_key")


@query("SELECT * FROM orders")
def compaction_roundtrip(inputs: Inputs) -> DataFrame:
    path = new_folder(inputs.spark, "compacted")
    layout.compacted(inputs.table("orders")).write.parquet(path)
    return inputs.spark.read.parquet(path)


@query("SELECT * FROM lineitem")
def z_order_roundtrip(inputs: Inputs) -> DataFrame:
    path = new_folder(inputs.spark, "z_ordered")
    rows = layout.z_ordered(inputs.table("lineitem"), ["l_partkey", "l_shipdate"], partitions=16)
    rows.write.parquet(path)
    return inputs.spark.read.parquet(path)


@query("""
SELECT 'lineitem' AS table_name, count(*) AS rows FROM lineitem
UNION ALL SELECT 'orders', count(*) FROM orders
""")
def table_sizes(inputs: Inputs) -> DataFrame:
    """Files and bytes are left out of the comparison: SQL does not see them."""
    sizes = [table_files(inputs.table(name), name) for name in ("lineitem", "orders")]
    return sizes[0].unionByName(sizes[1]).select("table_name", "rows")


@query("""
SELECT CAST(o_orderkey AS VARCHAR) AS order_id, o_totalprice AS total_amount,
  CASE WHEN o_orderdate >= TIMESTAMP '1998-01-01' THEN o_orderpriority END AS priority
FROM orders
""")
def schema_growth(inputs: Inputs) -> DataFrame:
    """Files written before a column came up read as NULL in it."""
    path = new_folder(inputs.spark, "growing")
    orders = inputs.table("orders")
    columns = [F.col("o_orderkey").cast("string").alias("order_id"), F.col("o_totalprice").alias("total_amount")]
    recent = F.col("o_orderdate") >= "1998-01-01"
    orders.where(~recent).select(*columns).write.parquet(path)
    newer = orders.where(recent).select(*columns, F.col("o_orderpriority").alias("priority"))
    newer.write.mode("append").parquet(path)
    return inputs.spark.read.option("mergeSchema", "true").parquet(path)


@query(f"""
WITH {SQL_CUSTOMERS}
SELECT customer_id, name, city, state, country FROM all_customers
""")
def wide_table_split(inputs: Inputs) -> DataFrame:
    """Address columns grouped into a struct, the table split in two and joined again."""
    nested = group_columns(inputs.customer_messages(), {"place": ["city", "state", "country"]})
    core, rest = split_columns(nested, ["customer_id"], ["name"])
    both = core.join(rest.select("customer_id", "place"), "customer_id")
    return both.select("customer_id", "name", "place.city", "place.state", "place.country")


@query(f"""
WITH {SQL_MESSAGES}
SELECT order_id, {_STATUS} AS _record_status, TRUE AS fewer_files, CAST(0 AS BIGINT) AS crowded_folders FROM messages
""")
def bronze_compacted(inputs: Inputs) -> DataFrame:
    """Bronze batches of many small files read the same after compaction; a second one finds nothing to do."""
    base, orders = new_folder(inputs.spark, "compacted"), inputs.order_messages_with_items()
    _land(f"{base}/landing", orders, "order_id")
    # files of a twentieth of the rows; compaction writes them without that limit
    few = orders.count() // 20 + 1
    bronze = BronzeTable(inputs.spark, f"{base}/bronze", ORDERS)
    crowded = BronzeTable(inputs.spark, f"{base}/bronze", ORDERS, few)
    ingest(crowded, f"{base}/landing", f"{base}/checkpoint").awaitTermination()
    before = folder_sizes(inputs.spark, bronze.path).agg(F.sum("files")).first()[0]
    bronze.compact()
    after = folder_sizes(inputs.spark, bronze.path).agg(F.sum("files")).first()[0]
    return bronze.read().select(
        "order_id", "_record_status", F.lit(after < before).alias("fewer_files"),
        F.lit(bronze.compact()).cast("bigint").alias("crowded_folders"),
    )


@query("""
SELECT 'o_orderstatus=' || o_orderstatus AS folder, CAST(1 AS BIGINT) AS files, TRUE AS has_bytes
FROM orders GROUP BY o_orderstatus
""")
def stored_folder_sizes(inputs: Inputs) -> DataFrame:
    """Files and bytes by folder, from the listing alone."""
    path = new_folder(inputs.spark, "orders")
    inputs.table("orders").repartition("o_orderstatus").write.partitionBy("o_orderstatus").parquet(path)
    return folder_sizes(inputs.spark, path).select("folder", "files", (F.col("size_bytes") > 0).alias("has_bytes"))
