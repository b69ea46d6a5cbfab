from datetime import datetime

import pytest
from pyspark.sql import functions as F

from quarrylake.operators.quality_rules import (
    EMAIL_PATTERN,
    add_audit_columns,
    apply_rules,
    format_rule,
    future_rule,
    range_rule,
    required_rules,
    split_by_status,
    type_rules,
    validate_required_fields,
)

COLUMNS = "order_id string, customer_id string, order_date string, total_amount double"


@pytest.mark.parametrize(
    "row, errors",
    [
        (("o1", "c1", "2024-01-01", 1.0), ""),
        (("o1", None, "2024-01-01", 1.0), "missing_customer_id"),
        (("o1", "", "2024-01-01", 1.0), "missing_customer_id"),
        (("o1", "   ", "2024-01-01", 1.0), "missing_customer_id"),
        ((None, None, "2024-01-01", None), "missing_order_id,missing_customer_id,missing_total_amount"),
    ],
)
def test_required_fields(spark, row, errors):
    df = spark.createDataFrame([row], COLUMNS)
    got = validate_required_fields(df, ["order_id", "customer_id", "total_amount"]).first()
    assert got._validation_errors == errors
    assert got._record_status == ("invalid" if errors else "valid")


def test_errors_follow_the_given_field_order(spark):
    df = spark.createDataFrame([(None, None, "d", 1.0)], COLUMNS)
    got = validate_required_fields(df, ["customer_id", "order_id"]).first()
    assert got._validation_errors == "missing_customer_id,missing_order_id"


def test_absent_column_fails_every_row(spark):
    df = spark.createDataFrame([("a",), ("b",)], "order_id string")
    checked = validate_required_fields(df, ["order_id", "email"])
    assert {(r._validation_errors, r._record_status) for r in checked.collect()} == {("missing_email", "invalid")}


def test_no_rules_gives_null_errors(spark):
    got = validate_required_fields(spark.createDataFrame([(None,)], "a string"), []).first()
    assert got._validation_errors is None and got._record_status == "valid"


def test_split_keeps_every_row(spark):
    df = spark.createDataFrame([("o1", "c", "d", 1.0), (None, "c", "d", 1.0)], COLUMNS)
    valid, invalid = split_by_status(validate_required_fields(df, ["order_id"]))
    assert (valid.count(), invalid.count()) == (1, 1)


def test_business_rules(spark):
    df = spark.createDataFrame(
        [
            ("2024-01-01", -1.0, "a@b.co"),
            ("31/12/2023", 5.0, "nobody"),
            ("2030-01-01", 5.0, None),
            (None, None, " "),
        ],
        "order_date string, total_amount double, email string",
    )
    rules = [
        *type_rules({"order_date": "timestamp"}),
        range_rule("total_amount", 0, low_open=True),
        future_rule("order_date", datetime(2025, 1, 1)),
        format_rule("email", EMAIL_PATTERN),
    ]
    errors = [r._validation_errors for r in apply_rules(df, rules).collect()]
    assert errors == ["out_of_range_total_amount", "bad_type_order_date,bad_format_email", "future_order_date", ""]


def test_audit_columns_use_one_time(spark):
    df = add_audit_columns(spark.range(1000).repartition(4), datetime(2024, 5, 1))
    assert {"_ingestion_timestamp", "_source_file"} <= set(df.columns)
    assert df.select("_ingestion_timestamp").distinct().count() == 1
    stamped = add_audit_columns(spark.range(1).withColumn("_source_file", F.lit("f")))
    assert stamped.first()._source_file == "f"


def test_required_rules_have_codes(spark):
    df = spark.createDataFrame([(1,)], "a int")
    assert [rule.code for rule in required_rules(df, ["a", "b"])] == ["missing_a", "missing_b"]


def test_status_filter_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([("o1", "c", "d", 1.0)], COLUMNS).write.parquet(path)
    checked = validate_required_fields(spark.read.parquet(path), ["total_amount"])
    plan = checked.where("_record_status = 'valid'")._jdf.queryExecution().executedPlan().toString()
    assert "Filter" in plan and "missing_total_amount" not in plan.split("Filter", 1)[1]
