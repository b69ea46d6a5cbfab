import pytest

from quarrylake.operators.compare import differing_rows, reconcile, reconcile_keys, snapshot_diff
from quarrylake.operators.quality_rules import range_rule

SCHEMA = "k string, a int, b int"


def test_value_that_moves_to_the_next_column_is_a_change(spark, rows):
    before = spark.createDataFrame([("x", None, 5), ("y", 1, 1)], SCHEMA)
    after = spark.createDataFrame([("x", 5, None), ("y", 1, 1)], SCHEMA)
    assert reconcile(before, after, ["k"]).first().changed_keys == 1
    assert rows(reconcile_keys(before, after, ["k"])) == [("x", "content", 1, 1)]
    assert rows(snapshot_diff(before, after, ["k"])) == [("update", "x", 5, None)]


def test_column_of_one_side_only_is_an_error(spark):
    whole, part = spark.createDataFrame([("x", 1, 2)], SCHEMA), spark.createDataFrame([("x", 1)], "k string, a int")
    for left, right in ((whole, part), (part, whole)):
        with pytest.raises(ValueError, match="b"):
            snapshot_diff(left, right, ["k"])
        with pytest.raises(ValueError, match="b"):
            reconcile(left, right, ["k"])


def test_range_without_limits_is_an_error():
    with pytest.raises(ValueError, match="no limit"):
        range_rule("a")


def test_only_branches_that_differ_are_left(spark, rows):
    before = spark.range(5000).selectExpr("cast(id as string) k", "cast(id as int) a", "1 b")
    after = before.where("a <> 17").selectExpr("k", "a", "if(a = 99, 2, b) b")
    lone = spark.createDataFrame([(None, 1, 1), (None, 1, 1), ("x", None, 5)], SCHEMA)
    before, after = before.unionByName(lone), after.unionByName(lone.limit(0)).unionByName(spark.createDataFrame([("x", 5, None), ("y", 0, 0)], SCHEMA))
    left, right = differing_rows(before, after, ["k"], branches=1 << 12)
    assert 0 < left.count() < 40 and 0 < right.count() < 40
    assert rows(reconcile_keys(left, right, ["k"])) == rows(reconcile_keys(before, after, ["k"]))
    keyed, keyed_after = before.dropna(subset=["k"]), after.dropna(subset=["k"])
    assert rows(snapshot_diff(*differing_rows(keyed, keyed_after, ["k"]), ["k"])) == rows(snapshot_diff(keyed, keyed_after, ["k"]))


def test_sides_without_rows_and_equal_sides(spark):
    some, none = spark.createDataFrame([("x", 1, 2), (None, 1, 2)], SCHEMA), spark.createDataFrame([], SCHEMA)
    assert [df.count() for df in differing_rows(some, none, ["k"])] == [2, 0]
    assert [df.count() for df in differing_rows(some, some, ["k"], partition="a")] == [0, 0]
    assert [df.count() for df in differing_rows(none, none, ["k"], partition="a")] == [0, 0]


def test_equal_partitions_are_not_read_again(spark, tmp_path, rows):
    df = spark.range(1000).selectExpr("cast(id as string) k", "cast(id as int) a", "if(id < 10, null, id % 8) part")
    changed = df.selectExpr("k", "if(a in (3, 505), -1, a) a", "part")
    for name, side in (("old", df), ("new", changed)):
        side.write.partitionBy("part").parquet(str(tmp_path / name))
    old, new = (spark.read.parquet(str(tmp_path / name)) for name in ("old", "new"))
    left, right = differing_rows(old, new, ["k"], partition="part")
    plan = left._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert "PartitionFilters: [((part#" in plan
    assert {row.part for row in left.select("part").distinct().collect()} == {None, 1}
    assert rows(snapshot_diff(left, right, ["k"]), "k") == [("3",), ("505",)]
