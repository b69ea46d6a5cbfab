import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from quarrylake.operators.history import (
    as_of_join,
    drop_unchanged,
    scd2_apply,
    scd2_history,
    scd2_merge,
    scd3_previous,
)
from quarrylake.operators.timeline import hot_keys, lay_out, value_before

DAY0 = datetime(2024, 1, 1)
VERSIONS = "k string, at timestamp, n int, v string"


def made_versions(seed, count=400):
    """A third of the rows belong to one key; times and values repeat."""
    rng = random.Random(seed)
    keys = ["hot"] * count + [f"k{i}" for i in range(40)] * (count // 20) + [None] * 15
    out = []
    for n, key in enumerate(keys):
        at = None if rng.random() < 0.02 else DAY0 + timedelta(hours=rng.randint(0, 500))
        out.append((key, at, n, rng.choice("abc")))
    return out


def in_order(versions):
    groups = {}
    for row in versions:
        groups.setdefault(row[0], []).append(row)
    for group in groups.values():
        group.sort(key=lambda r: (r[1] is not None, r[1] or DAY0, r[2]))
    return groups


@pytest.mark.parametrize("ranges", [1, 13])
@pytest.mark.parametrize("latest_first", [False, True])
def test_value_before_matches_brute_force(spark, ranges, latest_first):
    versions = made_versions(1)
    df = spark.createDataFrame(versions, VERSIONS).repartition(7)
    sparse = F.when(F.col("n") % 5 == 0, F.col("n"))
    got = value_before(
        df, ["k"], "at", sparse, "out", then_by=[F.col("n")], latest_first=latest_first, ranges=ranges
    )
    expected = {}
    for group in in_order(versions).values():
        last = None
        for row in reversed(group) if latest_first else group:
            expected[row[2]] = last
            last = row[2] if row[2] % 5 == 0 else last
    assert {r.n: r.out for r in got.collect()} == expected


@pytest.mark.parametrize("ranges", [1, 13])
def test_histories_match_brute_force(spark, ranges):
    versions = [v for v in made_versions(2) if v[1] is not None]
    df = spark.createDataFrame(versions, VERSIONS).repartition(5)
    groups = in_order(versions)

    history = scd2_history(df, ["k"], "at", ["n"], ranges=ranges)
    expected = {}
    for group in groups.values():
        for row, after in zip(group, [*group[1:], None]):
            expected[row[2]] = (row[1], after and after[1], after is None)
    assert {r.n: (r.valid_from, r.valid_to, r.is_current) for r in history.collect()} == expected

    changes = drop_unchanged(df, ["k"], "at", ["v"], ["n"], ranges=ranges)
    kept = {
        row[2] for group in groups.values() for before, row in zip([None, *group], group)
        if before is None or before[3] != row[3]
    }
    assert {r.n for r in changes.collect()} == kept

    short = scd2_history(df, ["k"], "at", ["n"], tracked=["v"], ranges=ranges)
    expected = {}
    for group in groups.values():
        group = [row for row in group if row[2] in kept]
        for row, after in zip(group, [*group[1:], None]):
            expected[row[2]] = (row[1], after and after[1], after is None)
    assert {r.n: (r.valid_from, r.valid_to, r.is_current) for r in short.collect()} == expected

    latest = scd3_previous(df, ["k"], "at", ["v"], ["n"], ranges=ranges)
    expected = {}
    for key, group in groups.items():
        changed = [row for row in group if row[2] in kept]
        expected[key] = (changed[-1][1], changed[-1][3], changed[-2][3] if len(changed) > 1 else None)
    assert {r.k: (r.current_since, r.current_v, r.previous_v) for r in latest.collect()} == expected


@pytest.mark.parametrize("ranges", [1, 13])
def test_as_of_join_matches_range_join(spark, ranges):
    versions = [v for v in made_versions(3, 200) if v[1] is not None]
    rng = random.Random(4)
    facts = [
        (i, rng.choice(["hot", "hot", "k1", "k2", "nobody", None]),
         None if rng.random() < 0.05 else DAY0 + timedelta(hours=rng.randint(-20, 520)))
        for i in range(600)
    ]
    history = scd2_history(spark.createDataFrame(versions, VERSIONS), ["k"], "at", ["n"])
    # one interval that was closed without a successor
    history = history.withColumn(
        "valid_to", F.when(F.col("is_current"), F.lit(DAY0 + timedelta(hours=510))).otherwise(F.col("valid_to"))
    )
    df = spark.createDataFrame(facts, "id int, k string, at timestamp")
    got = as_of_join(df, history, ["k"], "at", ["n", "v"], ranges=ranges)
    intervals = [(r.k, r.valid_from, r.valid_to, r.n, r.v) for r in history.collect()]
    expected = {}
    for i, key, at in facts:
        hits = [(n, v) for k, start, end, n, v in intervals if key and at and k == key and start <= at < end]
        assert len(hits) <= 1
        expected[i] = hits[0] if hits else (None, None)
    assert {r.id: (r.n, r.v) for r in got.collect()} == expected


def test_hot_keys_are_listed_by_count(spark, rows):
    df = spark.createDataFrame([("a",)] * 5 + [("b",)] * 2 + [(None,)] * 4, "k string")
    assert rows(hot_keys(df, ["k"], 4)) == [("a", 5), (None, 4)]


@pytest.mark.parametrize("seconds", ["id", "id - id"])
def test_one_key_is_spread_over_ranges(spark, seconds):
    """Also if all its rows have one time."""
    df = spark.range(20000).select(
        F.lit("hot").alias("k"), F.timestamp_seconds(F.expr(seconds)).alias("at"), F.col("id").alias("n")
    )
    sizes = lay_out(df, ["k"], "at", ranges=50).groupBy("_range").count().agg(F.max("count"), F.count("*")).first()
    assert sizes[0] < 1500 and sizes[1] > 40
    found = value_before(df, ["k"], "at", F.col("n"), "before", then_by=[F.col("n")], ranges=50)
    assert found.where("before <=> nullif(n - 1, -1)").count() == 20000


def test_apply_changes_to_history(spark, rows):
    history = spark.createDataFrame(
        [
            ("a", "x", DAY0, DAY0 + timedelta(days=1), False),
            ("a", "y", DAY0 + timedelta(days=1), None, True),
            ("b", "x", DAY0, None, True),
            ("c", "x", DAY0, None, True),
            ("d", "x", DAY0 + timedelta(days=9), None, True),
        ],
        "k string, v string, valid_from timestamp, valid_to timestamp, is_current boolean",
    )
    t = DAY0 + timedelta(days=5)
    changes = spark.createDataFrame(
        [("a", "z", t), ("b", "x", t), ("d", "late", t), ("e", "new", t)], "k string, v string, at timestamp"
    )
    got = rows(scd2_apply(history, changes, ["k"], ["v"], "at"), "k", "v", "valid_to", "is_current")
    assert got == [
        ("a", "x", DAY0 + timedelta(days=1), False),
        ("a", "y", t, False),
        ("a", "z", None, True),
        ("b", "x", None, True),
        ("c", "x", None, True),
        ("d", "x", None, True),
        ("e", "new", None, True),
    ]


def test_chained_look_backs_share_one_layout(spark):
    df = spark.createDataFrame([("a", DAY0, 1, "x")], VERSIONS)
    history = scd2_history(df, ["k"], "at", ["n"], tracked=["v"])
    history.collect()
    plan = history._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("rangepartitioning") == 0 and plan.count("FileScan parquet") <= 4
    once = scd2_history(df, ["k"], "at", ["n"])
    assert once._jdf.queryExecution().optimizedPlan().toString().count("Relation [") == 2


@pytest.mark.parametrize("tracked", [None, ["v"]])
def test_late_and_repeated_changes_match_a_rebuild(spark, rows, tracked):
    versions = [v for v in made_versions(5, 120) if v[1] is not None]
    df = spark.createDataFrame(versions, VERSIONS)
    late = F.col("n") % 3 == 0
    history = scd2_history(df.where(~late), ["k"], "at", ["n"])
    changes = df.where(late).unionByName(df.where("n % 4 = 0"))
    merged = scd2_merge(history, changes, ["k"], "at", ["n"], tracked)
    if tracked:  # keys without changes pass as they are
        changed = {r.k for r in changes.select("k").distinct().collect()}
        full = [r for r in rows(scd2_history(df, ["k"], "at", ["n"], tracked)) if r[0] in changed]
        assert [r for r in rows(merged) if r[0] in changed] == full
    else:
        assert rows(merged) == rows(scd2_history(df, ["k"], "at", ["n"]))


def test_a_late_change_cuts_a_closed_version(spark, rows):
    day = [DAY0 + timedelta(days=n) for n in range(10)]
    history = scd2_history(spark.createDataFrame([("a", day[1], "x"), ("a", day[5], "y"), ("b", day[2], "z")], "k string, at timestamp, v string"), ["k"], "at")
    changes = spark.createDataFrame([("a", day[3], "late"), ("a", day[3], "late"), ("a", day[0], "first"), ("c", day[4], "new"), ("b", day[2], "same time")], "k string, at timestamp, v string")
    assert rows(scd2_merge(history, changes, ["k"], "at"), "k", "v", "valid_from", "valid_to", "is_current") == [
        ("a", "first", day[0], day[1], False), ("a", "late", day[3], day[5], False), ("a", "x", day[1], day[3], False),
        ("a", "y", day[5], None, True), ("b", "z", day[2], None, True), ("c", "new", day[4], None, True),
    ]
    assert rows(scd2_merge(history, changes.where("false"), ["k"], "at")) == rows(history)
    assert scd2_merge(history.where("false"), changes, ["k"], "at").count() == 4
