from datetime import datetime

import pytest

from quarrylake.operators.compare import reconcile, reconcile_keys, snapshot_diff
from quarrylake.operators.upsert import update_columns, upsert

T1, T2, T3 = datetime(2024, 1, 1), datetime(2024, 1, 2), datetime(2024, 1, 3)
SCHEMA = "k string, v string, ts timestamp"


@pytest.mark.parametrize(
    "target, source, winner",
    [
        (("a", "old", T1), ("a", "new", T2), [("a", "new", T2)]),
        (("a", "old", T2), ("a", "tie", T2), [("a", "old", T2)]),
        (("a", "old", T3), ("a", "stale", T2), [("a", "old", T3)]),
        (("a", "old", None), ("a", "new", T2), [("a", "old", None)]),
        (("a", "old", T1), ("a", "new", None), [("a", "old", T1)]),
        (("a", "old", T1), ("a", None, T2), [("a", None, T2)]),
        (("a", "old", T1), ("b", "new", T1), [("a", "old", T1), ("b", "new", T1)]),
        ((None, "old", T1), (None, "new", T2), [(None, "new", T2), (None, "old", T1)]),
        (("a", None, None), ("b", None, None), [("a", None, None), ("b", None, None)]),
    ],
)
def test_merge_clauses(spark, rows, target, source, winner):
    merged = upsert(spark.createDataFrame([target], SCHEMA), spark.createDataFrame([source], SCHEMA), ["k"], "ts")
    assert rows(merged) == sorted(winner, key=str)


def test_merge_is_idempotent(spark, rows):
    target = spark.createDataFrame([("a", "1", T1), ("b", "2", T1)], SCHEMA)
    source = spark.createDataFrame([("a", "x", T2), ("c", "y", T2)], SCHEMA)
    once = upsert(target, source, ["k"], "ts")
    assert rows(upsert(once, source, ["k"], "ts")) == rows(once)


def test_equal_rows_without_key_all_stay(spark):
    df = spark.createDataFrame([(None, "x", T1)] * 50, SCHEMA)
    assert upsert(df, df, ["k"], "ts").count() == 100


def test_columns_of_one_side_are_kept(spark, rows):
    target = spark.createDataFrame([("a", "old", T1, 1)], SCHEMA + ", only_old int")
    source = spark.createDataFrame([("a", "new", T2, 7), ("b", "ins", T2, 8)], SCHEMA + ", only_new int")
    merged = upsert(target, source, ["k"], "ts")
    assert rows(merged, "k", "v", "only_old", "only_new") == [("a", "new", 1, 7), ("b", "ins", None, 8)]


def test_update_columns_never_inserts(spark, rows):
    target = spark.createDataFrame([("a", "1", T1), ("b", "2", T1)], SCHEMA)
    source = spark.createDataFrame([("a", None, 5), ("z", "9", 6)], "k string, v string, points int")
    got = update_columns(target, source, ["k"], ["v", "points"])
    assert rows(got, "k", "v", "points") == [("a", None, 5), ("b", "2", None)]


def test_change_feed(spark, rows):
    before = spark.createDataFrame([("a", "1", None), ("b", "2", T1), ("c", "3", T1)], SCHEMA)
    after = spark.createDataFrame([("a", "1", None), ("b", None, T1), ("d", "4", T1)], SCHEMA)
    got = rows(snapshot_diff(before, after, ["k"]), "change_type", "k", "v")
    assert got == [("delete", "c", "3"), ("insert", "d", "4"), ("update", "b", None)]


def test_reconcile(spark, rows):
    source = spark.createDataFrame([("a", "1", T1), ("b", "2", T1), ("c", "3", T1), (None, "n", T1)], SCHEMA)
    target = spark.createDataFrame([("a", "1", T1), ("a", "1", T1), ("b", "x", T1), ("d", "4", T1), (None, "n", T1)], SCHEMA)
    assert rows(reconcile_keys(source, target, ["k"])) == [
        ("a", "row_count", 1, 2),
        ("b", "content", 1, 1),
        ("c", "missing_in_target", 1, 0),
        ("d", "extra_in_target", 0, 1),
    ]
    assert tuple(reconcile(source, target, ["k"]).first()) == (4, 5, 1, 1, 2)
