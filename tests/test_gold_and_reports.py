from datetime import date, datetime

from pyspark.sql import functions as F

from quarrylake.operators import checks
from quarrylake.operators.quality_rules import validate_required_fields
from quarrylake.plans import gold, reports
from quarrylake.plans.silver import conform, rejects
from quarrylake.schemas import ORDERS, PRODUCTS, ddl

NOW = datetime(2024, 6, 1)
D = datetime(2024, 1, 1)


def facts(spark, *rows):
    schema = "order_id string, customer_id string, order_date timestamp, total_amount double, status string, payment_method string, _silver_processed_at timestamp"
    return spark.createDataFrame([(o, c, at, x, "s", "card", NOW) for o, c, at, x in rows], schema)


def customers(spark):
    schema = "customer_id string, name string, email_salt_key string, city string, state string, country string, created_at timestamp"
    return spark.createDataFrame([("c1", "A", "k", None, "CA", "US", D), ("c2", "B", "k", "Rome", None, "IT", D)], schema)


def test_order_summary_keeps_orders(spark, rows):
    fact = facts(spark, ("o1", "c1", D, 1.0), ("o2", "gone", D, 2.0), ("o3", None, D, 3.0))
    got = gold.order_summary(fact, customers(spark))
    assert len(got.columns) == 12
    assert rows(got, "order_id", "customer_id", "customer_name") == [("o1", "c1", "A"), ("o2", None, None), ("o3", None, None)]


def test_lifetime_value(spark, rows):
    fact = facts(
        spark, ("o1", "c1", D, 1.25), ("o1", "c1", D, 2.25), ("o2", "c1", datetime(2024, 1, 11), None), ("o3", None, D, 9.0)
    )
    got = gold.customer_lifetime_value(customers(spark), fact)
    assert len(got.columns) == 13
    assert rows(got, "customer_id", "total_orders", "total_spend", "avg_order_value", "customer_tenure_days") == [
        ("c1", 2, 3.5, 1.75, 10),
        ("c2", 0, None, None, None),
    ]


def bronze_orders(spark, *rows):
    schema = ddl({k: v for k, v in ORDERS.raw.items() if k in ("order_id", "customer_id", "order_date", "total_amount", "items")}) + ", _ingestion_timestamp timestamp"
    return validate_required_fields(spark.createDataFrame(list(rows), schema), ORDERS.required)


def test_product_sales_with_redelivery(spark, rows):
    orders = bronze_orders(
        spark,
        ("o1", "c", "2024-01-02", 1.0, [("p1", 2, 1.5), ("p1", 1, 1.0)], D),
        ("o1", "c", "2024-01-02", 1.0, [("p1", 2, 1.5)], NOW),
        ("o2", "c", "2024-01-01", 1.0, [("p1", None, 4.0)], D),
        ("o3", "c", "2024-01-01", 1.0, None, D),
        ("o4", "c", "2024-01-01", 1.0, [], D),
        (None, "c", "2024-01-01", 1.0, [("p1", 100, 1.0)], D),
    )
    products = spark.createDataFrame(
        [("p1", "A", "x", "b", 1.0, "k"), ("p2", "B", "x", "b", 2.0, "k")],
        "product_id string, name string, category string, brand string, price double, name_salt_key string",
    )
    columns = ["product_id", "times_ordered", "total_revenue", "avg_line_value", "first_sale_date"]
    got = gold.product_sales(products, orders)
    assert len(got.columns) == 11
    assert rows(got, *columns) == [("p1", 2, 7.0, 7.0 / 3, "2024-01-01"), ("p2", 0, 0.0, None, None)]
    assert rows(gold.product_sales_dedup(products, orders), *columns) == [
        ("p1", 2, 3.0, 3.0, "2024-01-01"),
        ("p2", 0, 0.0, None, None),
    ]


def test_redelivery_in_one_batch_counts_once(spark, rows):
    order = ("o1", "c", "2024-01-02", 1.0, [("p1", 2, 1.0), ("p1", 1, 1.0)], D)
    products = spark.createDataFrame(
        [("p1", "A", "x", "b", 1.0, "k")],
        "product_id string, name string, category string, brand string, price double, name_salt_key string",
    )
    got = gold.product_sales_dedup(products, bronze_orders(spark, order, order))
    assert rows(got, "times_ordered", "total_revenue") == [(1, 3.0)]


def test_small_amounts_add_up(spark):
    many = spark.range(1_000_000).selectExpr(
        "'o' AS order_id", "'c1' AS customer_id", "timestamp'2024-01-01' AS order_date", "0.00004D AS total_amount"
    )
    got = gold.customer_lifetime_value(customers(spark), many).where("customer_id = 'c1'").first()
    assert abs(got.total_spend - 40) < 1e-6 and abs(got.avg_order_value - 0.00004) < 1e-12


def test_views_shuffle_one_row_per_key_into_the_join(spark):
    fact = facts(spark, ("o1", "c1", D, 1.0))
    plan = gold.customer_lifetime_value(customers(spark), fact)._jdf.queryExecution().executedPlan().toString()
    join = plan.index("Join")
    assert "HashAggregate" in plan[join:] and "Aggregate" not in plan[:join]


def test_silver_conform_and_rejects(spark, rows):
    base = dict(product_id="p", name="n", price=1.0, weight=2.0, created_at="2024-01-01T00:00:00Z", updated_at=None)
    schema = ddl(PRODUCTS.raw) + ", _ingestion_timestamp timestamp, _source_file string"
    names = list(PRODUCTS.raw)
    made = [
        ({**base, "name": "old"}, D, "f1"),
        ({**base, "name": "same time, older", "updated_at": "2024-01-01T00:00:00Z"}, NOW, "f1"),
        ({**base, "name": "newest", "updated_at": "2024-01-02T00:00:00Z"}, NOW, "f1"),
        ({**base, "product_id": "q", "created_at": "yesterday"}, NOW, "f1"),
    ]
    df = spark.createDataFrame([(*[row.get(n) for n in names], at, f) for row, at, f in made], schema)
    bronze = validate_required_fields(df, PRODUCTS.required)
    got = conform(bronze, PRODUCTS, NOW, "salt")
    assert rows(got, "product_id", "name", "created_at") == [("p", "newest", D)]
    assert got.columns == [*PRODUCTS.silver, "name_salt_key", "_ingestion_timestamp", "_silver_processed_at"]
    assert rows(rejects(bronze, PRODUCTS), "product_id") == [("q",)]


def test_checks(spark, rows):
    df = spark.createDataFrame([("a", 1.0, D), ("a", -1.0, D), ("", 2.0, D), (None, None, None)], "k string, x double, at timestamp")
    wanted = [
        checks.completeness("k", 0.5),
        checks.completeness("k", 0.6),
        checks.uniqueness("k"),
        checks.value_range("x", F.col("x") <= 0, "x > 0"),
        checks.freshness("at", datetime(2024, 1, 1, 0, 29), 30),
        checks.freshness("at", datetime(2024, 1, 1, 0, 30), 30),
    ]
    got = checks.run_checks(df, "t", wanted, "r", NOW)
    assert got.columns == checks.RESULT_COLUMNS
    assert [r.check_result for r in got.collect()] == ["pass", "fail", "fail", "fail", "pass", "fail"]
    assert [r.actual_value for r in got.collect()][:4] == ["2", "2", "2", "1"]

    parent = spark.createDataFrame([("a",)], "id string")
    assert rows(checks.orphans(df, parent, "k", "id")) == [("", 1)]
    assert checks.referential_check(df, parent, "k", "id", "t", "r", NOW).first().check_result == "fail"


def test_freshness_counts_whole_minutes(spark):
    df = spark.createDataFrame([(datetime(2024, 1, 1, 0, 0, 59),)], "at timestamp")
    row = checks.freshness_sla(df, "at", "t", 29, datetime(2024, 1, 1, 0, 30, 0)).first()
    assert (row.actual_latency_minutes, row.sla_met) == (29.0, True)
    empty = checks.freshness_sla(df.where("at is null"), "at", "t", 29, NOW).first()
    assert (empty.actual_latency_minutes, empty.sla_met) == (None, False)


def test_gaps_and_volumes(spark, rows):
    df = spark.createDataFrame([("2024-01-01",), ("2024-01-01",), ("2024-01-04",), (None,)], "d string")
    assert rows(checks.date_gaps(df, "d")) == [(date(2024, 1, 2),), (date(2024, 1, 3),)]
    assert rows(checks.date_gaps(df, "d", "2023-12-31", "2024-01-02")) == [(date(2023, 12, 31),), (date(2024, 1, 2),)]
    runs = spark.createDataFrame(
        [("r1", "t", "l", 1, 100), ("r2", "t", "l", 2, 120), ("r3", "t", "l", 3, 90), ("r4", "u", "l", 1, 5)],
        "run_id string, topic_name string, layer string, s int, records_written long",
    ).withColumn("start_time", F.timestamp_seconds("s")).drop("s")
    got = rows(checks.volume_changes(runs), "run_id", "previous_records", "check_result")
    assert got == [("r1", None, "first"), ("r2", 100, "pass"), ("r3", 120, "warn"), ("r4", None, "first")]


def test_spikes_use_a_gap_filled_axis(spark, rows):
    daily = spark.createDataFrame(
        [("a", date(2024, 1, 1), 10.0), ("a", date(2024, 1, 2), 30.0), ("a", date(2024, 1, 20), 5.0)],
        "k string, day date, amount double",
    )
    got = {r.day.day: (r.amount, r.trailing_mean, r.is_spike) for r in reports.spend_spikes(daily, ["k"]).collect()}
    assert len(got) == 20
    assert got[1] == (10.0, None, False) and got[2] == (30.0, 10.0, True)
    assert got[9] == (0.0, 30.0 / 7, False) and got[15] == (0.0, 0.0, False) and got[20] == (5.0, 0.0, True)


def test_top_rows_ties(spark):
    df = spark.createDataFrame([("b", 1.0), ("a", 1.0), ("c", None)], "k string, x double")
    assert [r.k for r in reports.top_rows(df, "x", "k", 3).collect()] == ["a", "b", "c"]


def test_alert_and_patterns(spark, rows):
    df = spark.createDataFrame([("valid",)] * 9 + [("invalid",)], "_record_status string")
    assert tuple(checks.invalid_share(df, 0.05).first()) == (10, 1, 0.1, True)
    assert tuple(checks.invalid_share(df, 0.1).first()) == (10, 1, 0.1, False)
    jobs = spark.createDataFrame([("My Bronze job", 2.0), ("x", 1.0), (None, 4.0)], "name string, usage_quantity double")
    layered = jobs.withColumn("layer", reports.group_by_pattern("name", {"Bronze": "%Bronze%"}))
    assert rows(reports.cost_by(layered, ["layer"], 0.5)) == [("Bronze", 2.0, 1.0), ("Other", 5.0, 2.5)]
