from datetime import datetime

from pyspark.sql import functions as F

from quarrylake.operators.latest import keep_latest, keep_latest_delivery

T1, T2 = datetime(2024, 1, 1), datetime(2024, 1, 2)
SCHEMA = "k string, ts timestamp, v string, items array<struct<a:int>>, props map<string,string>"


def test_newest_row_wins_and_ties_are_settled(spark, rows):
    df = spark.createDataFrame(
        [
            ("a", T1, "old", None, {"x": "1"}),
            ("a", T2, "new", [(1,)], None),
            ("b", T1, "x", [(1,)], None),
            ("b", T1, "x", [(2,)], None),
            ("c", None, "untimed", None, None),
            ("c", T1, "timed", None, None),
            (None, T1, "no key", None, None),
        ],
        SCHEMA,
    )
    for parts in (1, 5):
        got = rows(keep_latest(df.repartition(parts), ["k"], ["ts"]).drop("props"), "k", "v", F.to_json("items"))
        assert got == [
            ("a", "new", '[{"a":1}]'),
            ("b", "x", '[{"a":2}]'),
            ("c", "timed", None),
            (None, "no key", None),
        ]


def test_keys_are_cut_before_the_shuffle(spark):
    df = spark.createDataFrame([("a", T1)], "k string, ts timestamp")
    plan = keep_latest(df, ["k"], ["ts"])
    text = plan._jdf.queryExecution().executedPlan().toString()
    exchange = text.index("Exchange hashpartitioning")
    assert "WindowGroupLimit" in text[exchange:]


def test_whole_last_delivery_is_kept(spark, rows):
    df = spark.createDataFrame(
        [("a", T1, "1"), ("a", T2, "2"), ("a", T2, "3"), ("b", T1, "4"), ("b", T1, "4"), ("c", None, "5"), (None, T1, "6")],
        "k string, ts timestamp, v string",
    )
    got = rows(keep_latest_delivery(df, ["k"], "ts"), "k", "v")
    assert got == [("a", "2"), ("a", "3"), ("b", "4"), ("b", "4"), ("c", "5"), (None, "6")]
