import re
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from quarrylake.operators.key_filter import key_filters, meeting
from quarrylake.operators.reshape import group_columns, split_columns
from quarrylake.sources import layout
from quarrylake.sources.tables import BucketedTable, Folders, PartitionedTable, VersionedTable, folder_sizes, listed_files, table_files
from quarrylake.workspace import new_folder, shared_root

T1, T2, T3 = datetime(2024, 1, 1), datetime(2024, 1, 2), datetime(2024, 1, 3)
D1, D2, D3 = date(2024, 1, 1), date(2024, 1, 2), date(2024, 1, 3)
SCHEMA = "k string, v string, ts timestamp, day date"


def test_versions_and_failed_write(spark, rows, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "dim"))
    assert not table.exists()
    with pytest.raises(FileNotFoundError):
        table.read()
    table.merge(spark.createDataFrame([("a", "1", T1)], "k string, v string, ts timestamp"), ["k"], "ts")
    before = table.read()
    table.merge(spark.createDataFrame([("a", "2", T2), ("b", "3", T2)], "k string, v string, ts timestamp"), ["k"], "ts")
    assert rows(before, "k", "v") == [("a", "1")]
    assert rows(table.read(), "k", "v") == [("a", "2"), ("b", "3")]

    failing = table.read().withColumn("v", F.raise_error(F.lit("lost")))
    with pytest.raises(Exception, match="lost"):
        table.write(failing)
    assert table.versions() == [1, 2] and table.read().count() == 2
    assert table.write(table.read()) == 3
    table.forget(keep=1)
    assert table.versions() == [3]


def first_rows(spark):
    return spark.createDataFrame(
        [("a", "1", T1, D1), ("b", "1", T1, D1), ("c", "1", T1, D2), ("m", "1", T1, D3)], SCHEMA
    )


def later_rows(spark):
    """a changes, m moves from D3 (which empties) to D2, n is new, c is stale."""
    return spark.createDataFrame(
        [("a", "2", T2, D1), ("m", "2", T2, D2), ("n", "2", T2, D2), ("c", "0", datetime(2023, 1, 1), D2)], SCHEMA
    )


MERGED = [("a", "2", D1), ("b", "1", D1), ("c", "1", D2), ("m", "2", D2), ("n", "2", D2)]


def test_merge_by_partition(spark, rows, tmp_path):
    table = PartitionedTable(spark, str(tmp_path / "fact"), "day")
    table.merge(first_rows(spark), ["k"], "ts")
    table.merge(later_rows(spark), ["k"], "ts")
    assert rows(table.read(), "k", "v", "day") == MERGED
    assert rows(table.partitions()) == [(D1,), (D2,)]
    table.merge(later_rows(spark), ["k"], "ts")
    assert rows(table.read(), "k", "v", "day") == MERGED


def test_untouched_partitions_are_not_rewritten(spark, tmp_path):
    table = PartitionedTable(spark, str(tmp_path / "fact"), "day")
    table.merge(first_rows(spark), ["k"], "ts")
    files = {p.name for p in (tmp_path / "fact" / "day=2024-01-02").glob("*.parquet")}
    table.merge(spark.createDataFrame([("a", "9", T3, D1)], SCHEMA), ["k"], "ts")
    assert {p.name for p in (tmp_path / "fact" / "day=2024-01-02").glob("*.parquet")} == files


@pytest.mark.parametrize("step", ["filters", "rows", "emptied"])
def test_merge_cut_off_while_taken_over_is_finished_later(spark, rows, tmp_path, monkeypatch, step):
    path = str(tmp_path / "fact")
    table = PartitionedTable(spark, path, "day")
    table.merge(first_rows(spark), ["k"], "ts")
    table.holding(first_rows(spark), ["k"])  # the filters exist

    def lost(*_):
        raise OSError("driver lost")

    with monkeypatch.context() as patch:
        if step == "filters":
            patch.setattr(PartitionedTable, "_write_filters", lost)
        elif step == "rows":
            patch.setattr(PartitionedTable, "_save", lost)
        else:
            drop = Folders.drop
            patch.setattr(Folders, "drop", lambda self, to: lost() if "day=2024-01-03" in to else drop(self, to))
        with pytest.raises(OSError):
            table.merge(later_rows(spark), ["k"], "ts")
    again = PartitionedTable(spark, path, "day")
    again.merge(spark.createDataFrame([("z", "3", T3, D3)], SCHEMA), ["k"], "ts")
    assert rows(again.read(), "k", "v", "day") == sorted([*MERGED, ("z", "3", D3)], key=str)


def test_merge_reads_keys_of_partitions_that_can_hold_them_only(spark, rows, tmp_path):
    table = PartitionedTable(spark, str(tmp_path / "fact"), "day", SCHEMA)
    days = [(f"k{i}", "1", T1, date(2024, 1, 1 + i % 28)) for i in range(2800)]
    table.merge(spark.createDataFrame(days, SCHEMA), ["k"], "ts")
    source = spark.createDataFrame([("k3", "2", T2, D1), ("new", "2", T2, D2), (None, "2", T2, D2)], SCHEMA)
    held = table.holding(source, ["k"])
    plan = held._jdf.queryExecution().executedPlan().toString()
    [filters] = re.findall(r"PartitionFilters: \[([^\]]*)", plan)
    assert "day" in filters and re.findall(r"20\d\d-\d\d-\d\d|\b\d{5}\b", filters) in (["2024-01-04"], ["19726"])
    assert rows(held) == [(date(2024, 1, 4),)]
    table.merge(source, ["k"], "ts")
    assert rows(table.read().where("k = 'k3'"), "v", "day") == [("2", D1)]
    assert table.read().count() == 2802
    # the filters follow the moved key
    assert rows(table.holding(source.where("k = 'k3'"), ["k"])) == [(D1,)]


def test_small_changes_come_into_the_partitions_together(spark, rows, tmp_path, monkeypatch):
    put, merged = (PartitionedTable(spark, str(tmp_path / name), "day", SCHEMA) for name in ("put", "merged"))
    changes = [
        [("a", "1", T1, D1), ("b", "1", T1, D1)],
        [("a", "2", T2, D2), ("b", "equal", T1, D2), ("c", "2", T2, D3)],  # a moves, b stays
        [("c", "older", T1, D1), ("d", "3", T3, D3)],
        [(None, "x", T1, D1), ("e", "no time", None, D1)],
        [(None, "y", T1, D1), ("e", "5", T3, D2), ("a", "5", T3, D1)],
        [("f", "6", T1, D2), ("d", "6", T3, D1)],
    ]
    saved, save = [], PartitionedTable._save
    monkeypatch.setattr(PartitionedTable, "_save", lambda self, *about: saved.append(self.path) or save(self, *about))
    for number, change in enumerate(changes):
        source = spark.createDataFrame(change, SCHEMA)
        put.put(source, ["k"], "ts")
        merged.merge(source, ["k"], "ts")
        assert rows(put.read(), "k", "v", "day") == rows(merged.read(), "k", "v", "day")
        if number == 2:
            assert put.path not in saved and rows(put.partitions()) == [(D1,), (D2,), (D3,)]
    assert rows(put.read().where(F.col("day") == D1), "k") == rows(merged.read().where(F.col("day") == D1), "k")
    put.settle()
    assert rows(put._rows(), "k", "v", "ts", "day") == rows(merged.read(), "k", "v", "ts", "day")
    assert saved.count(merged.path) == 6 > saved.count(put.path) and not (tmp_path / "put" / "_pending").exists()


def test_small_changes_are_taken_in_before_they_outgrow_the_table(spark, rows, tmp_path, monkeypatch):
    from quarrylake.sources import tables

    monkeypatch.setattr(tables, "_FEW_BYTES", 0)
    table, sizes = PartitionedTable(spark, str(tmp_path / "fact"), "day", SCHEMA), []
    for at in range(6):
        table.put(spark.createDataFrame([(f"k{at}{i}", "1", T1, D1) for i in range(50)], SCHEMA), ["k"], "ts")
        sizes.append(table._rows().count())
        assert table.read().count() == 50 * (at + 1)
    assert sizes[0] == 50 and 1 < len(set(sizes)) < 6


def test_change_that_was_put_survives_a_cut_off_settling(spark, rows, tmp_path, monkeypatch):
    table = PartitionedTable(spark, str(tmp_path / "fact"), "day", SCHEMA)
    table.merge(first_rows(spark), ["k"], "ts")
    table.put(later_rows(spark), ["k"], "ts")
    with monkeypatch.context() as patch:
        patch.setattr(PartitionedTable, "_save", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            table.settle()
    again = PartitionedTable(spark, table.path, "day", SCHEMA)
    assert rows(again.read(), "k", "v", "day") == MERGED
    again.settle()
    assert rows(again._rows(), "k", "v", "day") == MERGED


def test_key_filters_miss_no_key_and_name_few_others(spark):
    known = spark.range(20_000).select("id", (F.col("id") % 10).alias("part"))
    filters = key_filters(known, ["id"], "part")
    assert meeting(filters, spark.range(3, 4).toDF("id"), ["id"], "part").collect() == [(3,)]
    assert meeting(filters, known, ["id"], "part").count() == 10
    assert meeting(filters, spark.range(50_000, 52_000).toDF("id"), ["id"], "part").count() <= 1
    assert meeting(filters.where("false"), known, ["id"], "part").count() == 0
    nulls = known.select(F.lit(None).cast("bigint").alias("id"), "part")
    assert meeting(key_filters(nulls, ["id"], "part"), nulls, ["id"], "part").count() == 0


def test_key_filters_meet_by_equal_hashes(spark):
    """No source key is held against the lists of all partitions."""
    known = spark.range(1000).select("id", (F.col("id") % 500).alias("part"))
    met = meeting(key_filters(known, ["id"], "part"), spark.range(0, 1000, 250).toDF("id"), ["id"], "part")
    plan = met._jdf.queryExecution().optimizedPlan().toString()
    assert re.search(r"Join LeftSemi, \(key_hash#\d+L = key_hash#\d+L\)", plan)
    assert sorted(row[0] for row in met.collect()) == [0, 250]


def test_bucketed_merge_rewrites_one_bucket(spark, rows, tmp_path):
    path = tmp_path / "dim"
    table = BucketedTable(spark, str(path), ["k"], buckets=8)
    assert not table.exists()
    schema = "k string, v string, at int"
    table.merge(spark.createDataFrame([(f"k{i}", "old", 1) for i in range(100)] + [(None, "x", 1)], schema), ["k"], "at")
    files = set(path.rglob("*.parquet"))
    table.merge(spark.createDataFrame([("k7", "new", 2), ("k7", "older", 1)], schema), ["k"], "at")
    gone = files - set(path.rglob("*.parquet"))
    assert len({file.parent for file in gone}) == 1
    assert table.read().columns == ["k", "v", "at"]
    assert rows(table.read().where("v <> 'old'")) == sorted([("k7", "new", 2), (None, "x", 1)], key=str)
    assert table.read().count() == 101
    table.merge(spark.createDataFrame([("k8", "grown", 3, 5)], schema + ", more int"), ["k"], "at")
    assert rows(table.read().where("more is not null or k = 'k9'")) == [("k8", "grown", 3, 5), ("k9", "old", 1, None)]
    with pytest.raises(ValueError, match="dealt by"):
        table.merge(spark.createDataFrame([("a", "b", 1)], schema), ["v"], "at")


def test_failed_change_leaves_the_table(spark, rows, tmp_path):
    table = PartitionedTable(spark, str(tmp_path / "fact"), "day")
    table.write(first_rows(spark))
    with pytest.raises(Exception, match="lost"):
        table.rewrite([D1], lambda old: old.withColumn("v", F.raise_error(F.lit("lost"))))
    assert rows(table.read(), "k", "v") == [("a", "1"), ("b", "1"), ("c", "1"), ("m", "1")]
    table.rewrite([D1], lambda old: old.withColumn("points", F.lit(3)))
    assert rows(table.read(), "k", "points") == [("a", 3), ("b", 3), ("c", None), ("m", None)]


def test_partition_filter_prunes(spark, tmp_path):
    table = PartitionedTable(spark, str(tmp_path / "fact"), "day")
    table.write(first_rows(spark))
    picked = table.read().where(F.col("day").between(F.lit("2024-01-01"), F.lit("2024-01-02")))
    plan = picked._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan and picked.count() == 3


def test_layouts_keep_rows(spark, rows, tmp_path):
    df = spark.range(3000).select(
        F.col("id"),
        F.when(F.col("id") % 7 != 0, F.concat(F.lit("CUST-"), F.lpad(F.col("id").cast("string"), 8, "0"))).alias("name"),
        F.timestamp_seconds(F.col("id") * 60).alias("at"),
    )
    for out in (
        layout.compacted(df),
        layout.clustered(df, "name", 4),
        layout.z_ordered(df, ["name", "at"], 8),
    ):
        assert rows(out) == rows(df)


def test_z_order_narrows_both_columns(spark):
    grid = spark.range(10000).select(F.floor(F.col("id") / 100).alias("x"), (F.col("id") % 100).alias("y"))
    spans = (
        layout.z_ordered(grid, ["x", "y"], 16)
        .groupBy(F.spark_partition_id())
        .agg((F.max("x") - F.min("x")).alias("dx"), (F.max("y") - F.min("y")).alias("dy"))
        .agg(F.avg("dx"), F.avg("dy"))
        .first()
    )
    assert spans[0] < 60 and spans[1] < 60


def test_z_order_tells_texts_apart_whatever_their_beginnings(spark):
    """Ids with a long common beginning keep their ranks beside one odd key."""
    ids = [(f"customer-of-the-shop-{i:06d}",) for i in range(10_000)] + [("a",), (None,), ("é" * 1000,)]
    df = spark.createDataFrame(ids, "id string")
    [cuts] = layout._cuts(df, ["id"])
    ranked = layout._ranked(df, "id", cuts, "rank")
    assert ranked.select("rank").distinct().count() > 200
    assert ranked.where("id is null").first()["rank"] == 256
    below = sorted((r.id, r["rank"]) for r in ranked.dropna().collect())
    assert [rank for _, rank in below] == sorted(rank for _, rank in below)
    assert layout.z_ordered(df.where("false"), ["id"], 4).count() == 0


def test_file_sizes(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(1000).repartition(3).write.parquet(path)
    row = table_files(spark.read.parquet(path), "t").first()
    total = sum(p.stat().st_size for p in (tmp_path / "t").glob("*.parquet"))
    assert (row.table_name, row.files, row.size_bytes, row.rows) == ("t", 3, total, 1000)


def test_wide_tables(spark):
    df = spark.createDataFrame([(1, "a", "b", "c")], "id int, x string, y string, z string")
    nested = group_columns(df, {"xy": ["x", "y"]})
    assert nested.columns == ["id", "z", "xy"] and nested.first().xy.y == "b"
    core, rest = split_columns(df, ["id"], ["z"])
    assert core.columns == ["id", "z"] and rest.columns == ["id", "x", "y"]


def test_workspace_follows_the_session(spark):
    assert new_folder(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
    assert shared_root(spark) == spark.conf.get("spark.checkpoint.dir")


def test_partition_names_with_signs_and_repeated_source_rows(spark, rows, tmp_path):
    schema = "k int, v string, at int, slot string"
    table = PartitionedTable(spark, str(tmp_path / "slots"), "slot")
    old = [(1, "old", 1, "2024-01-01 10:00"), (2, "stays", 1, "2024-01-01 10:00"), (3, "null", 1, None)]
    table.merge(spark.createDataFrame(old, schema), ["k"], "at")
    new = [(1, "new", 3, "2024-01-01 11:00"), (1, "between", 2, "2024-01-01 12:00"), (4, "a", 1, "x=y/z"), (4, "b", 2, "x=y/z")]
    table.merge(spark.createDataFrame(new, schema), ["k"], "at")
    assert rows(table.read(), "k", "v") == [(1, "new"), (2, "stays"), (3, "null"), (4, "b")]
    table.rewrite(["2024-01-01 10:00"], lambda part: part.withColumn("v", F.upper("v")))
    assert rows(table.read(), "k", "v") == [(1, "new"), (2, "STAYS"), (3, "null"), (4, "b")]
    with pytest.raises(ValueError, match="no such partitions"):
        table.rewrite(["2024-01-01 13:00"], lambda part: part)


def test_versioned_merge_takes_the_newest_of_repeated_source_rows(spark, rows, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "dim"))
    for batch in ([(1, "a", 1), (1, "b", 2)], [(1, "c", 3), (1, "d", 4)]):
        table.merge(spark.createDataFrame(batch, "k int, v string, at int"), ["k"], "at")
    assert rows(table.read()) == [(1, "d", 4)]


def test_folder_sizes_come_from_a_listing(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(1000).selectExpr("id", "id % 3 part").repartition(4).write.partitionBy("part").parquet(path)
    spark.range(5).write.parquet(f"{path}/_staged/rows")
    sizes = {r.folder: (r.files, r.size_bytes, r.smallest, r.largest) for r in folder_sizes(spark, path).collect()}
    expected = {}
    for folder in (tmp_path / "t").glob("part=*"):
        lengths = [p.stat().st_size for p in folder.glob("*.parquet")]
        expected[folder.name] = (len(lengths), sum(lengths), min(lengths), max(lengths))
    assert sizes == expected
    files = listed_files(spark, path)
    assert "content" not in files._jdf.queryExecution().executedPlan().toString()
    spark.range(3).write.parquet(f"{path}/flat")
    assert {r.folder for r in folder_sizes(spark, f"{path}/flat").collect()} == {""}
