"""Data quality, privacy and raw-text queries."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from quarrylake.functions.columns import generate_salt_key
from quarrylake.operators import checks
from quarrylake.operators.privacy import (
    MASKED_EMAIL,
    filter_rows_for_role,
    mask_columns,
    rotate_salt,
)
from quarrylake.operators.quality_rules import (
    EMAIL_PATTERN,
    apply_rules,
    format_rule,
    future_rule,
    range_rule,
    required_rules,
    type_rules,
)
from quarrylake.plans import reports
from quarrylake.queries import query
from quarrylake.queries.inputs import (
    PROCESSED_AT,
    SALT,
    SQL_CUSTOMERS,
    SQL_DELIVERIES,
    SQL_FACT,
    SQL_MESSAGES,
    Inputs,
)
from quarrylake.schemas import CUSTOMERS, ORDERS
from quarrylake.sources.landing import CORRUPT_COLUMN, parse_lines, rescued, unwrap_envelope

NOW = datetime(2001, 1, 1)
EVENTS_NOW = datetime(2024, 1, 31)


@query(f"""
WITH {SQL_MESSAGES}
SELECT order_id, concat_ws(',',
    CASE WHEN order_id IS NULL OR trim(order_id) = '' THEN 'missing_order_id' END,
    CASE WHEN customer_id IS NULL THEN 'missing_customer_id' END,
    CASE WHEN total_amount IS NULL THEN 'missing_total_amount' END,
    CASE WHEN TRY_CAST(order_date AS TIMESTAMP) IS NULL THEN 'bad_type_order_date' END,
    CASE WHEN total_amount <= 5000 OR total_amount > 450000 THEN 'out_of_range_total_amount' END,
    CASE WHEN TRY_CAST(order_date AS TIMESTAMP) > TIMESTAMP '2001-01-01' THEN 'future_order_date' END
  ) AS _validation_errors
FROM messages
""")
def business_rules_orders(inputs: Inputs) -> DataFrame:
    messages = inputs.order_messages()
    rules = [
        *required_rules(messages, ORDERS.required),
        *type_rules({"order_date": "timestamp", "total_amount": "double"}),
        range_rule("total_amount", 5000, 450000, low_open=True),
        future_rule("order_date", NOW),
    ]
    return apply_rules(messages, rules).select("order_id", "_validation_errors")


@query("""
SELECT CAST(c_custkey AS VARCHAR) AS customer_id,
  CASE WHEN c_acctbal < 0 THEN 'missing_email'
       WHEN c_acctbal >= 9000 THEN 'bad_format_email' ELSE '' END AS _validation_errors
FROM customer
""")
def business_rules_customers(inputs: Inputs) -> DataFrame:
    """Rich customers get an address without its host."""
    messages = inputs.customer_messages()
    broken = F.when(F.col("lifetime_value") >= 9000, F.regexp_replace("email", "@.*", "@"))
    messages = messages.withColumn("email", broken.otherwise(F.col("email")))
    rules = [*required_rules(messages, CUSTOMERS.required), format_rule("email", EMAIL_PATTERN)]
    return apply_rules(messages, rules).select("customer_id", "_validation_errors")


@query(f"""
WITH {SQL_CUSTOMERS}
SELECT customer_id, sha256(concat_ws('|', 'not-a-secret', coalesce(email, ''))) AS email_salt_key,
  sha256(concat_ws('|', 'not-a-secret', name, state)) AS name_state_key
FROM all_customers
""")
def salt_keys(inputs: Inputs) -> DataFrame:
    keyed = generate_salt_key(inputs.customer_messages(), ["email"], "email_salt_key", salt=SALT)
    keyed = generate_salt_key(keyed, ["name", "state"], "name_state_key", salt=SALT)
    return keyed.select("customer_id", "email_salt_key", "name_state_key")


@query(f"""
WITH {SQL_CUSTOMERS}
SELECT DISTINCT sha256(concat_ws('|', 'not-a-secret', coalesce(email, ''))) AS email_salt_key
FROM all_customers
""")
def distinct_salt_keys(inputs: Inputs) -> DataFrame:
    keyed = generate_salt_key(inputs.customer_messages(), ["email"], "email_salt_key", salt=SALT)
    return keyed.select("email_salt_key").distinct()


@query(f"""
WITH {SQL_CUSTOMERS}
SELECT customer_id, email_salt_key, sha256(concat_ws('|', 'next-salt', email)) AS email_salt_key_new
FROM dim_customers
""")
def rotated_salt_keys(inputs: Inputs) -> DataFrame:
    rotated = rotate_salt(inputs.dim_customers, ["email"], SALT, "next-salt")
    return rotated.select("customer_id", "email_salt_key", "email_salt_key_new")


@query(f"""
WITH {SQL_CUSTOMERS}
SELECT customer_id, CASE WHEN email IS NOT NULL THEN '****@****.com' END AS email, name
FROM all_customers
""")
def masked_customers(inputs: Inputs) -> DataFrame:
    masked = mask_columns(inputs.customer_messages(), {"email": MASKED_EMAIL}, privileged=False)
    return masked.select("customer_id", "email", "name")


@query(f"""
WITH {SQL_FACT}, {SQL_CUSTOMERS}
SELECT o.order_id, o.total_amount, c.country AS customer_country
FROM fact o JOIN dim_customers c ON o.customer_id = c.customer_id
WHERE c.country IN ('EUROPE', 'MIDDLE EAST', 'AFRICA')
""")
def region_filtered_orders(inputs: Inputs) -> DataFrame:
    """Orders an analyst of one group of regions may see."""
    region = inputs.table("region").select(F.col("r_name").alias("customer_country"))
    emea = F.col("customer_country").isin("EUROPE", "MIDDLE EAST", "AFRICA")
    grants = region.withColumn("role", F.when(emea, "emea_analysts").otherwise("other_analysts"))
    customer = inputs.dim_customers.select("customer_id", F.col("country").alias("customer_country"))
    orders = inputs.fact_orders.join(customer, "customer_id")
    seen = filter_rows_for_role(orders, grants, "emea_analysts", "customer_country")
    return seen.select("order_id", "total_amount", "customer_country")


@query(f"WITH {SQL_DELIVERIES} SELECT _validation_errors, count(*) AS records FROM bronze GROUP BY 1")
def error_histogram(inputs: Inputs) -> DataFrame:
    return checks.error_histogram(inputs.bronze_orders)


@query(f"""
WITH {SQL_DELIVERIES}
SELECT error, count(*) AS records
FROM (SELECT unnest(string_split(_validation_errors, ',')) AS error FROM bronze) WHERE error <> ''
GROUP BY error
""")
def error_by_field(inputs: Inputs) -> DataFrame:
    return checks.errors_by_field(inputs.bronze_orders)


@query(f"""
WITH {SQL_DELIVERIES}
SELECT count(*) AS records, count(*) FILTER (_record_status = 'invalid') AS invalid_records,
  CAST(count_if(_record_status = 'invalid') AS DOUBLE) / count(*) AS invalid_share,
  CAST(count_if(_record_status = 'invalid') AS DOUBLE) / count(*) > 0.05 AS alert
FROM bronze
""")
def invalid_share(inputs: Inputs) -> DataFrame:
    return checks.invalid_share(inputs.bronze_orders)


@query(f"WITH {SQL_DELIVERIES} SELECT _record_status, count(*) AS records FROM bronze GROUP BY 1")
def status_breakdown(inputs: Inputs) -> DataFrame:
    return reports.status_breakdown(inputs.bronze_orders)


def _result_sql(number, kind, description, expected, actual, passed, threshold, source) -> str:
    return f"""
SELECT '{source}.{kind}.{number}' AS check_id, 'run-1' AS run_id, '{source}' AS table_name,
  '{kind}' AS check_type, '{description}' AS check_description,
  CASE WHEN {passed} THEN 'pass' ELSE 'fail' END AS check_result,
  '{expected}' AS expected_value, CAST({actual} AS VARCHAR) AS actual_value,
  CAST({threshold} AS DOUBLE) AS threshold, TIMESTAMP '2002-01-02' AS checked_at
FROM {source}"""


_CHECKED = "bronze"
_RESULTS = [
    _result_sql(0, "completeness", "customer_id is filled", ">= 0.99 of rows",
                "count(nullif(customer_id, ''))", "count(nullif(customer_id, '')) >= count(*) * 0.99",
                "0.99", _CHECKED),
    _result_sql(1, "uniqueness", "order_id is unique", "one per row",
                "count(DISTINCT order_id)", "count(DISTINCT order_id) = count(*)", "NULL", _CHECKED),
    _result_sql(2, "range", "total_amount > 0", "0",
                "count_if(total_amount <= 0)", "count_if(total_amount <= 0) = 0", "NULL", _CHECKED),
    _result_sql(3, "freshness", "_ingestion_timestamp is recent", "within 30 minutes",
                "max(_ingestion_timestamp)",
                "max(_ingestion_timestamp) > TIMESTAMP '2002-01-02' - INTERVAL 30 MINUTE", "30", _CHECKED),
]


@query(f"""
WITH {SQL_DELIVERIES}, {SQL_CUSTOMERS}
{' UNION ALL '.join(_RESULTS)}
UNION ALL
SELECT 'bronze.referential.0', 'run-1', 'bronze', 'referential', 'customer_id has a parent',
  CASE WHEN count(*) = 0 THEN 'pass' ELSE 'fail' END, '0', CAST(count(*) AS VARCHAR),
  CAST(NULL AS DOUBLE), TIMESTAMP '2002-01-02'
FROM bronze b WHERE customer_id IS NOT NULL
  AND NOT EXISTS (SELECT 1 FROM dim_customers c WHERE c.customer_id = b.customer_id)
""")
def dq_results(inputs: Inputs) -> DataFrame:
    table = inputs.bronze_orders
    wanted = [
        checks.completeness("customer_id", 0.99),
        checks.uniqueness("order_id"),
        checks.value_range("total_amount", F.col("total_amount") <= 0, "total_amount > 0"),
        checks.freshness("_ingestion_timestamp", PROCESSED_AT, 30),
    ]
    in_table = checks.run_checks(table, "bronze", wanted, "run-1", PROCESSED_AT)
    parents = checks.referential_check(
        table, inputs.dim_customers, "customer_id", "customer_id", "bronze", "run-1", PROCESSED_AT
    )
    return in_table.unionByName(parents)


@query(f"""
WITH {SQL_FACT}, {SQL_CUSTOMERS}
SELECT customer_id AS orphan_key, count(*) AS child_rows FROM fact
WHERE customer_id NOT IN (SELECT customer_id FROM dim_customers) GROUP BY customer_id
""")
def orphan_customers(inputs: Inputs) -> DataFrame:
    return checks.orphans(inputs.fact_orders, inputs.dim_customers, "customer_id", "customer_id")


@query("""
SELECT 'events' AS table_name, 'freshness' AS sla_type, 30 AS sla_threshold_minutes,
  CAST(datesub('minute', max(ts), TIMESTAMP '2024-01-31') AS DOUBLE) AS actual_latency_minutes,
  datesub('minute', max(ts), TIMESTAMP '2024-01-31') <= 30 AS sla_met,
  TIMESTAMP '2024-01-31' AS checked_at
FROM events
""")
def freshness_sla(inputs: Inputs) -> DataFrame:
    return checks.freshness_sla(inputs.table("events"), "ts", "events", 30, EVENTS_NOW)


@query("""
WITH days AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders)
SELECT CAST(axis.d AS DATE) AS missing_date
FROM (SELECT unnest(generate_series((SELECT min(d) FROM days), (SELECT max(d) FROM days), INTERVAL 1 DAY)) AS d) axis
WHERE CAST(axis.d AS DATE) NOT IN (SELECT d FROM days)
""")
def date_gaps(inputs: Inputs) -> DataFrame:
    """Days between the first and last order that have none."""
    return checks.date_gaps(inputs.table("orders"), "o_orderdate")


@query("""
SELECT json_key, count(*) AS records FROM (SELECT unnest(json_keys(props)) AS json_key FROM events)
WHERE json_key NOT IN ('user_id', 'event_type') GROUP BY json_key
""")
def json_drift_keys(inputs: Inputs) -> DataFrame:
    return checks.unknown_json_keys(inputs.table("events"), "props", ["user_id", "event_type"])


@query("""
SELECT 'm-' || event_id AS message_id, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS sent_at,
  event_type, value, CAST(json_extract(props, '$.k') AS BIGINT) AS k
FROM events
""")
def envelope_unwrap(inputs: Inputs) -> DataFrame:
    message = F.to_json(
        F.struct("event_type", "value", F.get_json_object("props", "$.k").cast("bigint").alias("k"))
    )
    envelope = F.struct(
        F.lit("Notification").alias("Type"),
        F.concat(F.lit("m-"), F.col("event_id").cast("string")).alias("MessageId"),
        message.alias("Message"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("Timestamp"),
    )
    lines = inputs.table("events").select(F.to_json(envelope).alias("line"))
    return unwrap_envelope(lines, "line", "event_type string, value double, k bigint")


@query("""
SELECT CASE WHEN o_totalprice > 400000 THEN NULL ELSE CAST(o_orderkey AS VARCHAR) END AS order_id,
  CASE WHEN o_totalprice > 400000 THEN NULL ELSE o_totalprice END AS total_amount,
  o_totalprice > 400000 AS is_corrupt
FROM orders
""")
def corrupt_lines(inputs: Inputs) -> DataFrame:
    """The lines of large orders lost their last character on the way."""
    fields = F.struct(
        F.col("o_orderkey").cast("string").alias("order_id"), F.col("o_totalprice").alias("total_amount")
    )
    line = F.to_json(fields)
    cut = F.when(F.col("o_totalprice") > 400000, F.regexp_replace(line, r"\}$", "")).otherwise(line)
    parsed = parse_lines(inputs.table("orders").select(cut.alias("line")), "line", ORDERS)
    return parsed.select("order_id", "total_amount", F.col(CORRUPT_COLUMN).isNotNull().alias("is_corrupt"))


def _drifted_lines(inputs: Inputs) -> DataFrame:
    """Order lines of a sender that changed: amounts, quantities, fields and line ends."""
    price, status = F.col("o_totalprice"), F.col("o_orderstatus")
    rare = (status == "P") & (F.col("o_orderpriority") == "5-LOW")
    parts = F.concat_ws(
        ",",
        F.concat(F.lit('"order_id":"'), F.col("o_orderkey").cast("string"), F.lit('"')),
        F.when(~rare, F.concat(F.lit('"customer_id":"'), F.col("o_custkey").cast("string"), F.lit('"'))),
        F.when(price > 400000, F.lit('"total_amount":"n/a"')).otherwise(F.lit('"total_amount":12.5')),
        F.when(F.col("o_orderpriority") == "1-URGENT", F.lit('"coupon":{"code":"U","share":10}')),
        F.concat(F.lit('"items":[{"product_id":"1","quantity":'), F.when(status == "P", F.lit('"two"')).otherwise(F.lit("2")), F.lit("}]")),
    )
    end = F.when(price < 5000, F.lit("")).otherwise(F.lit("}"))
    return inputs.table("orders").select(F.concat(F.lit("{"), parts, end).alias("line"))


@query("""
WITH o AS (
  SELECT *, CASE WHEN o_totalprice > 400000 THEN '"n/a"' ELSE '12.5' END AS amount,
    CASE WHEN o_orderstatus = 'P' THEN '"two"' ELSE '2' END AS quantity FROM orders)
SELECT CAST(o_orderkey AS VARCHAR) AS order_id, 'total_amount' AS field, 'n/a' AS raw FROM o
WHERE o_totalprice > 400000
UNION ALL
SELECT CAST(o_orderkey AS VARCHAR), 'coupon', '{"code":"U","share":10}' FROM o
WHERE o_orderpriority = '1-URGENT' AND o_totalprice >= 5000
UNION ALL
SELECT CAST(o_orderkey AS VARCHAR), 'items', '[{"product_id":"1","quantity":"two"}]' FROM o
WHERE o_orderstatus = 'P' AND o_totalprice >= 5000
UNION ALL
SELECT NULL, '_corrupt_record', '{"order_id":"' || o_orderkey || '",'
  || CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '5-LOW' THEN '' ELSE '"customer_id":"' || o_custkey || '",' END
  || '"total_amount":12.5,' || CASE WHEN o_orderpriority = '1-URGENT' THEN '"coupon":{"code":"U","share":10},' ELSE '' END
  || '"items":[{"product_id":"1","quantity":' || quantity || '}]' FROM o
WHERE o_totalprice < 5000
""")
def rescued_fields(inputs: Inputs) -> DataFrame:
    """Each value that the order columns lost, with its field."""
    rows = rescued(_drifted_lines(inputs), "line", ORDERS)
    return rows.select("order_id", F.explode("rescued").alias("field", "raw"))


@query("""
WITH o AS (SELECT * FROM orders WHERE o_totalprice >= 5000), counted AS (
  SELECT count(*) AS n, count(*) FILTER (o_orderpriority = '1-URGENT') AS urgent,
    count(*) FILTER (o_totalprice > 400000) AS large, count(*) FILTER (o_orderstatus = 'P') AS partial,
    count(*) FILTER (o_orderstatus = 'P' AND o_orderpriority = '5-LOW') AS rare FROM o)
SELECT unnest(['coupon', 'coupon.code', 'coupon.share', 'total_amount', 'items[].quantity', 'customer_id',
    'order_date', 'status', 'payment_method', 'shipping_address_id', 'items[].unit_price']) AS path,
  unnest(['new', 'new', 'new', 'retyped', 'retyped', 'missing', 'missing', 'missing', 'missing', 'missing', 'missing']) AS finding,
  unnest(['OBJECT<code: STRING, share: BIGINT>', 'STRING', 'BIGINT', 'STRING', 'STRING', NULL, NULL, NULL, NULL, NULL, NULL]) AS found_type,
  unnest([urgent, urgent, urgent, large, partial, rare, n, n, n, n, n]) AS records
FROM counted
""")
def drifted_paths(inputs: Inputs) -> DataFrame:
    """New, retyped and missing paths of the order lines, nested ones too, with counts."""
    return checks.json_drift(_drifted_lines(inputs), "line", StructType.fromDDL(ORDERS.raw_ddl))
