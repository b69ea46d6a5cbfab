"""Upserts, history, point-in-time lookups and comparisons."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarrylake.operators import compare
from quarrylake.operators.history import (
    as_of_join,
    scd2_apply,
    scd2_history,
    scd2_merge,
    scd3_previous,
)
from quarrylake.operators.upsert import update_columns, upsert
from quarrylake.queries import query
from quarrylake.queries.inputs import FIRST_DELIVERY, SECOND_DELIVERY, Inputs, stamp
from quarrylake.workspace import new_folder


def _accounts(inputs: Inputs) -> DataFrame:
    return inputs.table("customer").select(
        F.concat(F.lit("C-"), F.col("c_custkey").cast("string")).alias("account_id"),
        F.col("c_acctbal").alias("balance"),
        F.col("c_mktsegment").alias("segment"),
        stamp(FIRST_DELIVERY).alias("_ingestion_timestamp"),
    )


def _changed_accounts(inputs: Inputs) -> DataFrame:
    """A change for every account, by segment newer, equal, older or without a time.

    Suppliers come in as new accounts.
    """
    segment = F.col("segment")
    moment = (
        F.when(segment.isin("BUILDING", "AUTOMOBILE"), stamp(SECOND_DELIVERY))
        .when(segment == "MACHINERY", stamp(FIRST_DELIVERY))
        .when(segment == "HOUSEHOLD", F.lit("2001-12-31 00:00:00").cast("timestamp"))
    )
    moved = _accounts(inputs).withColumns(
        {"balance": F.when(segment != "AUTOMOBILE", F.col("balance") + 100), "_ingestion_timestamp": moment}
    )
    new = inputs.table("supplier").select(
        F.concat(F.lit("S-"), F.col("s_suppkey").cast("string")).alias("account_id"),
        F.col("s_acctbal").alias("balance"),
        F.lit("SUPPLIER").alias("segment"),
        F.lit(None).cast("timestamp").alias("_ingestion_timestamp"),
    )
    return moved.unionByName(new)


_ACCOUNTS = """
accounts AS (
  SELECT 'C-' || c_custkey AS account_id, c_acctbal AS balance, c_mktsegment AS segment,
    TIMESTAMP '2002-01-01 00:00:00' AS _ingestion_timestamp FROM customer
), changes AS (
  SELECT account_id, CASE WHEN segment = 'AUTOMOBILE' THEN NULL ELSE balance + 100 END AS balance, segment,
    CASE WHEN segment IN ('BUILDING', 'AUTOMOBILE') THEN TIMESTAMP '2002-01-01 01:00:00'
         WHEN segment = 'MACHINERY' THEN TIMESTAMP '2002-01-01 00:00:00'
         WHEN segment = 'HOUSEHOLD' THEN TIMESTAMP '2001-12-31 00:00:00' END AS _ingestion_timestamp
  FROM accounts
  UNION ALL
  SELECT 'S-' || s_suppkey, s_acctbal, 'SUPPLIER', NULL FROM supplier
)"""


@query(f"""
WITH {_ACCOUNTS}
SELECT coalesce(t.account_id, s.account_id) AS account_id,
  CASE WHEN pick THEN s.balance ELSE t.balance END AS balance,
  CASE WHEN pick THEN s.segment ELSE t.segment END AS segment,
  CASE WHEN pick THEN s._ingestion_timestamp ELSE t._ingestion_timestamp END AS _ingestion_timestamp
FROM (
  SELECT t, s, t.account_id IS NULL OR coalesce(s._ingestion_timestamp > t._ingestion_timestamp, false) AS pick
  FROM accounts t FULL JOIN changes s ON t.account_id = s.account_id
)
""")
def upsert_scd1(inputs: Inputs) -> DataFrame:
    return upsert(_accounts(inputs), _changed_accounts(inputs), ["account_id"], "_ingestion_timestamp")


_DISCOUNTS = f"""
discounts AS (
  SELECT l_orderkey AS o_orderkey, sum(l_extendedprice * l_discount) AS discount_amount
  FROM lineitem GROUP BY l_orderkey
)"""


@query(f"""
WITH {_DISCOUNTS}
SELECT o.o_orderkey, o.o_totalprice, d.discount_amount
FROM orders o LEFT JOIN discounts d ON o.o_orderkey = d.o_orderkey
""", rounded=("discount_amount",))
def backfill_columns(inputs: Inputs) -> DataFrame:
    """Add the discount given on each order's lines; orders without lines keep NULL."""
    orders = inputs.table("orders").select("o_orderkey", "o_totalprice")
    return update_columns(orders, _discounts(inputs), ["o_orderkey"], ["discount_amount"])


def _discounts(inputs: Inputs) -> DataFrame:
    given = F.sum(F.col("l_extendedprice") * F.col("l_discount")).alias("discount_amount")
    return inputs.table("lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(given)


def _versions(inputs: Inputs) -> DataFrame:
    """Each order states its customer's current priority."""
    return inputs.table("orders").select(
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").alias("changed_at"),
        F.col("o_orderkey").alias("order_id"),
        F.col("o_orderpriority").alias("priority"),
    )


_HISTORY = """
history AS (
  SELECT o_custkey AS customer_id, o_orderkey AS order_id, o_orderpriority AS priority,
    o_orderdate AS valid_from,
    lead(o_orderdate) OVER w AS valid_to,
    lead(o_orderkey) OVER w IS NULL AS is_current
  FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)
)"""


@query(f"WITH {_HISTORY} SELECT * FROM history")
def scd2_versions(inputs: Inputs) -> DataFrame:
    return scd2_history(_versions(inputs), ["customer_id"], "changed_at", ["order_id"])


@query(f"WITH {_HISTORY} SELECT * FROM history")
def scd2_late_changes(inputs: Inputs) -> DataFrame:
    """A history of two thirds of the versions, into which the others come late and partly twice."""
    versions = _versions(inputs)
    late = F.col("order_id") % 3 == 0
    history = scd2_history(versions.where(~late), ["customer_id"], "changed_at", ["order_id"])
    changes = versions.where(late)
    repeated = versions.where(F.col("order_id") % 5 == 0)
    return scd2_merge(history, changes.unionByName(repeated), ["customer_id"], "changed_at", ["order_id"])


_CHANGES = """
changes AS (
  SELECT o_custkey AS customer_id, o_orderdate AS changed_at, o_orderkey AS order_id,
    o_orderpriority AS priority
  FROM orders
  QUALIFY o_orderpriority IS DISTINCT FROM
    lag(o_orderpriority) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)
)"""


@query(f"""
WITH {_CHANGES}
SELECT customer_id, order_id, priority, changed_at AS valid_from,
  lead(changed_at) OVER w AS valid_to, lead(order_id) OVER w IS NULL AS is_current
FROM changes WINDOW w AS (PARTITION BY customer_id ORDER BY changed_at, order_id)
""")
def scd2_changes_only(inputs: Inputs) -> DataFrame:
    return scd2_history(
        _versions(inputs), ["customer_id"], "changed_at", ["order_id"], tracked=["priority"]
    )


@query(f"""
WITH {_CHANGES}
SELECT customer_id, changed_at AS current_since, priority AS current_priority,
  lag(priority) OVER w AS previous_priority
FROM changes WINDOW w AS (PARTITION BY customer_id ORDER BY changed_at, order_id)
QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY changed_at DESC, order_id DESC) = 1
""")
def scd3_previous_value(inputs: Inputs) -> DataFrame:
    return scd3_previous(_versions(inputs), ["customer_id"], "changed_at", ["priority"], ["order_id"])


@query(f"""
WITH {_HISTORY}, shipped AS (
  SELECT o_custkey AS customer_id, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_shipdate
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
)
SELECT s.customer_id, s.l_orderkey, s.l_linenumber, s.l_partkey, s.l_suppkey, s.l_quantity, s.l_shipdate, h.priority,
  h.order_id AS version_order
FROM shipped s LEFT JOIN history h ON s.customer_id = h.customer_id
  AND h.valid_from <= s.l_shipdate AND (s.l_shipdate < h.valid_to OR h.valid_to IS NULL)
""")
def point_in_time(inputs: Inputs) -> DataFrame:
    """The customer's priority at the time each line was shipped."""
    history = scd2_history(_versions(inputs), ["customer_id"], "changed_at", ["order_id"])
    customer = inputs.table("orders").select(
        F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("customer_id")
    )
    lines = inputs.table("lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_shipdate"
    )
    shipped = lines.join(customer, "l_orderkey")
    found = as_of_join(
        shipped,
        history.withColumnRenamed("order_id", "version_order"),
        ["customer_id"],
        "l_shipdate",
        ["priority", "version_order"],
    )
    return found


@query(f"""
WITH {_ACCOUNTS}, history AS (
  SELECT account_id, segment, _ingestion_timestamp AS valid_from FROM accounts
), moved AS (
  SELECT account_id, CASE WHEN balance > 5000 THEN 'PREMIUM' ELSE segment END AS segment,
    _ingestion_timestamp AS changed_at FROM changes
), joined AS (
  SELECT h.account_id AS old_id, m.account_id AS new_id, h.segment AS old_segment, m.segment AS new_segment,
    h.valid_from, m.changed_at,
    h.account_id IS NULL OR (m.account_id IS NOT NULL AND coalesce(m.changed_at > h.valid_from, false)
      AND h.segment IS DISTINCT FROM m.segment) AS replaces
  FROM history h FULL JOIN moved m ON h.account_id = m.account_id
)
SELECT old_id AS account_id, old_segment AS segment, valid_from,
  CASE WHEN replaces THEN changed_at END AS valid_to, NOT replaces AS is_current
FROM joined WHERE old_id IS NOT NULL
UNION ALL
SELECT new_id, new_segment, changed_at, NULL, true FROM joined WHERE replaces
""")
def scd2_apply_changes(inputs: Inputs) -> DataFrame:
    history = _accounts(inputs).select(
        "account_id",
        "segment",
        F.col("_ingestion_timestamp").alias("valid_from"),
        F.lit(None).cast("timestamp").alias("valid_to"),
        F.lit(True).alias("is_current"),
    )
    premium = F.when(F.col("balance") > 5000, F.lit("PREMIUM")).otherwise(F.col("segment"))
    changes = _changed_accounts(inputs).select(
        "account_id", premium.alias("segment"), F.col("_ingestion_timestamp").alias("changed_at")
    )
    return scd2_apply(history, changes, ["account_id"], ["segment"], "changed_at")


@query(f"""
WITH {_ACCOUNTS}, kept AS (SELECT account_id, balance, segment FROM changes WHERE segment <> 'FURNITURE')
SELECT CASE WHEN a.account_id IS NULL THEN 'insert' WHEN k.account_id IS NULL THEN 'delete' ELSE 'update' END
    AS change_type,
  coalesce(k.account_id, a.account_id) AS account_id,
  CASE WHEN k.account_id IS NULL THEN a.balance ELSE k.balance END AS balance,
  coalesce(k.segment, a.segment) AS segment
FROM accounts a FULL JOIN kept k ON a.account_id = k.account_id
WHERE a.balance IS DISTINCT FROM k.balance OR a.segment IS DISTINCT FROM k.segment
""")
def snapshot_diff(inputs: Inputs) -> DataFrame:
    before = _accounts(inputs).drop("_ingestion_timestamp")
    after = _changed_accounts(inputs).where(F.col("segment") != "FURNITURE").drop("_ingestion_timestamp")
    return compare.snapshot_diff(before, after, ["account_id"])


def _two_copies(inputs: Inputs) -> tuple[DataFrame, DataFrame]:
    """The orders, and a copy that lost, doubled and changed some."""
    source = inputs.table("orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus")
    price = F.col("o_totalprice")
    copy = source.where(price <= 480000).withColumn(
        "o_totalprice", F.when(price < 20000, price + 1).otherwise(price)
    )
    doubled = source.where(price.between(200000, 210000))
    return source, copy.unionByName(doubled)


@query("""
SELECT count(*) + 0 AS source_rows,
  count(*) FILTER (o_totalprice <= 480000) + count(*) FILTER (o_totalprice BETWEEN 200000 AND 210000) AS target_rows,
  count(*) FILTER (o_totalprice > 480000) AS missing_keys, CAST(0 AS BIGINT) AS extra_keys,
  count(*) FILTER (o_totalprice < 20000 OR o_totalprice BETWEEN 200000 AND 210000) AS changed_keys
FROM orders
""")
def reconcile_totals(inputs: Inputs) -> DataFrame:
    return compare.reconcile(*_two_copies(inputs), ["o_orderkey"])


_FINDINGS = """
SELECT o_orderkey,
  CASE WHEN o_totalprice > 480000 THEN 'missing_in_target'
       WHEN o_totalprice < 20000 THEN 'content' ELSE 'row_count' END AS finding,
  CAST(1 AS BIGINT) AS source_rows,
  CAST(CASE WHEN o_totalprice > 480000 THEN 0 WHEN o_totalprice < 20000 THEN 1 ELSE 2 END AS BIGINT) AS target_rows
FROM orders
WHERE o_totalprice > 480000 OR o_totalprice < 20000 OR o_totalprice BETWEEN 200000 AND 210000
"""


@query(_FINDINGS)
def reconcile_by_key(inputs: Inputs) -> DataFrame:
    return compare.reconcile_keys(*_two_copies(inputs), ["o_orderkey"])


@query(_FINDINGS)
def reconcile_by_branch(inputs: Inputs) -> DataFrame:
    """The same findings; only rows of branches with another checksum are compared by key."""
    keys = ["o_orderkey"]
    return compare.reconcile_keys(*compare.differing_rows(*_two_copies(inputs), keys), keys)


@query("""
SELECT o_orderkey,
  CASE WHEN o_totalprice > 480000 THEN 'delete' ELSE 'update' END AS change_type,
  o_custkey, CASE WHEN o_totalprice > 480000 THEN o_totalprice ELSE o_totalprice + 1 END AS o_totalprice
FROM orders WHERE o_orderkey % 64 = 7 AND (o_totalprice > 480000 OR o_totalprice < 20000)
""")
def stored_snapshot_diff(inputs: Inputs) -> DataFrame:
    """Change feed of two stored tables that differ in a few buckets: the other buckets are read once, for their checksums."""
    base, keys = new_folder(inputs.spark, "snapshots"), ["o_orderkey"]
    orders = inputs.table("orders").select("o_orderkey", "o_custkey", "o_totalprice")
    few, price = F.col("o_orderkey") % 64 == 7, F.col("o_totalprice")
    changed = orders.where(~few | (price <= 480000)).withColumn(
        "o_totalprice", F.when(few & (price < 20000), price + 1).otherwise(price)
    )
    bucket = F.pmod("o_orderkey", F.lit(64)).cast("int")
    for name, rows in (("before", orders), ("after", changed)):
        dealt = rows.withColumn("bucket", bucket)
        dealt.hint("rebalance", F.col("bucket")).write.partitionBy("bucket").parquet(f"{base}/{name}")
    before, after = (inputs.spark.read.parquet(f"{base}/{name}") for name in ("before", "after"))
    narrowed = compare.differing_rows(before, after, keys, partition="bucket")
    return compare.snapshot_diff(*narrowed, keys).drop("bucket")
