import gzip
import json
from datetime import date

import pytest
from pyspark.sql import functions as F

from quarrylake.operators.checks import json_drift, unknown_json_keys
from quarrylake.plans.run_log import read_runs
from quarrylake.schemas import CUSTOMERS, ORDERS, TOPICS
from quarrylake.sources.landing import (
    read_landing,
    read_landing_hours,
    read_raw_lines,
    rescued,
    unwrap_envelope,
    write_landing,
)
from quarrylake.streaming.bronze import BronzeTable, bulk_load, ingest, write_batch
from quarrylake.streaming.silver import SilverTable, refresh, stream_to_silver


class Landing:
    """Gzip JSON files under hour folders, as they are delivered."""

    def __init__(self, root):
        self.root, self.count = root, 0
        self.path = str(root)

    def put(self, *lines, hour="01"):
        folder = self.root / "year=2024" / "month=01" / "day=01" / f"hour={hour}"
        folder.mkdir(parents=True, exist_ok=True)
        self.count += 1
        with gzip.open(folder / f"{self.count}.json.gz", "wt") as f:
            f.writelines((x if isinstance(x, str) else json.dumps(x)) + "\n" for x in lines)


def order(order_id="o1", **more):
    return {
        "order_id": order_id,
        "customer_id": "c1",
        "order_date": "2024-01-01T10:00:00Z",
        "total_amount": 5.0,
        "items": [{"product_id": "p1", "quantity": 2, "unit_price": 2.5}],
        **more,
    }


@pytest.fixture
def landing(tmp_path):
    return Landing(tmp_path / "landing")


@pytest.fixture
def bronze(spark, tmp_path):
    return BronzeTable(spark, str(tmp_path / "bronze"), ORDERS)


def run(bronze, landing, tmp_path, checkpoint="cp", **options):
    query = ingest(bronze, landing.path, str(tmp_path / checkpoint), **options)
    assert query.awaitTermination(120)
    assert query.exception() is None


def test_broken_and_odd_lines(spark, rows, landing, bronze, tmp_path):
    landing.put(
        order("ok"),
        order("extra", new_field=1),
        order("no items", items=None),
        order("bad amount", total_amount="abc"),
        order("bad quantity", items=[{"product_id": "p1", "quantity": "two", "unit_price": 1.0}]),
        order("   "),
        '{"order_id": "cut", "cust',
        {"order_id": "absent"},
    )
    run(bronze, landing, tmp_path)
    assert rows(bronze.valid(), "order_id") == [("extra",), ("no items",), ("ok",)]
    got = rows(bronze.invalid(), "order_id", "_validation_errors", F.col("_corrupt_record").isNotNull())
    assert got == [
        ("   ", "missing_order_id", False),
        ("absent", "missing_customer_id,missing_order_date,missing_total_amount", False),
        ("bad amount", "missing_total_amount,corrupt_record", True),
        ("bad quantity", "corrupt_record", True),
        (None, "missing_order_id,missing_customer_id,missing_order_date,missing_total_amount,corrupt_record", True),
    ]
    assert bronze.read().select("_ingestion_timestamp").distinct().count() == 1
    assert "landing/year=2024" in bronze.read().first()._source_file
    assert "hour" not in bronze.read().columns


def test_files_are_taken_once_and_in_bounded_batches(spark, rows, landing, bronze, tmp_path):
    log = str(tmp_path / "log")
    for i in range(5):
        landing.put(order(f"o{i}"), hour=f"{i:02d}")
    run(bronze, landing, tmp_path, max_files=2, run_log=log)
    run(bronze, landing, tmp_path, max_files=2, run_log=log)
    assert bronze.read().count() == 5
    assert sorted(r.records_read for r in read_runs(spark, log).collect()) == [1, 2, 2]
    landing.put(hour="09")
    landing.put(order("late"), order(None), hour="09")
    run(bronze, landing, tmp_path, max_files=1, run_log=log)
    logged = read_runs(spark, log).agg(F.sum("records_written"), F.sum("records_invalid")).first()
    assert tuple(logged) == (6, 1)


def test_retried_batch_replaces_itself(spark, rows, bronze):
    batch = spark.createDataFrame([("o1", "c", "2024-01-01", 1.0)], "order_id string, customer_id string, order_date string, total_amount double")
    for _ in range(2):
        write_batch(batch, 7, "feed-a", bronze)
    assert bronze.read().count() == 1


def test_fresh_checkpoint_does_not_overwrite(spark, landing, bronze, tmp_path):
    landing.put(order())
    run(bronze, landing, tmp_path, "cp1")
    run(bronze, landing, tmp_path, "cp2")
    assert bronze.read().count() == 2 and len(bronze.complete_batches({})) == 2


def test_bulk_load_can_be_repeated(spark, rows, landing, bronze):
    landing.put(order("o1"), order(None))
    for _ in range(2):
        bulk_load(bronze, landing.path, "history")
    assert rows(bronze.read(), "order_id", "_record_status") == [("o1", "valid"), (None, "invalid")]


def test_interval_trigger(spark, landing, bronze, tmp_path):
    landing.put(order("o1"))
    query = ingest(bronze, landing.path, str(tmp_path / "cp"), every="1 second")
    query.processAllAvailable()
    landing.put(order("o2"), hour="02")
    query.processAllAvailable()
    query.stop()
    assert bronze.read().count() == 2


def test_failed_batch_is_logged(spark, bronze, tmp_path):
    batch = spark.range(1).select(F.raise_error(F.lit("lost")).cast("string").alias("order_id"))
    with pytest.raises(Exception, match="lost"):
        write_batch(batch, 0, "feed", bronze, str(tmp_path / "log"))
    row = read_runs(spark, str(tmp_path / "log")).first()
    assert row.status == "failed" and "lost" in row.error_message
    assert bronze.complete_batches({}) == {}


def test_silver_takes_only_new_complete_batches(spark, rows, landing, bronze, tmp_path):
    silver = SilverTable(spark, str(tmp_path / "silver"), ORDERS)
    landing.put(order("o1"), order("o2", order_date="31/12/2023"), order("o3"))
    run(bronze, landing, tmp_path)
    assert len(refresh(bronze, silver)) == 1
    assert refresh(bronze, silver) == {}
    assert rows(silver.read(), "order_id") == [("o1",), ("o3",)]
    assert rows(silver.rejects(bronze), "order_id", "order_date") == [("o2", "31/12/2023")]

    landing.put(order("o1", status="shipped", order_date="2024-01-02T00:00:00Z"), order("o4"), hour="05")
    run(bronze, landing, tmp_path)
    feed = next(iter(bronze.complete_batches({})))
    # a batch that is still being written has no success marker
    half = f"{bronze.path}/feed={feed}/batch_id=2/_record_status=valid"
    bronze.valid().limit(1).drop("feed", "batch_id", "_record_status").write.parquet(half)
    assert refresh(bronze, silver) == {feed: 1}
    assert rows(silver.read(), "order_id", "status") == [("o1", "shipped"), ("o3", None), ("o4", None)]
    assert rows(silver.read().select(F.col("order_day").cast("string")).distinct()) == [("2024-01-01",), ("2024-01-02",)]


def test_optimize_rewrites_only_the_given_partitions(spark, rows, landing, bronze, tmp_path):
    silver = SilverTable(spark, str(tmp_path / "silver"), ORDERS)
    landing.put(*[order(f"o{i}", customer_id=f"c{i % 5}") for i in range(50)], order("x", order_date="2024-01-02T00:00:00Z"))
    run(bronze, landing, tmp_path)
    refresh(bronze, silver)
    before, folder = rows(silver.read()), tmp_path / "silver" / "rows"
    kept = [p.name for p in (folder / "order_day=2024-01-02").glob("*.parquet")]
    silver.optimize(2, [date(2024, 1, 1)])
    assert rows(silver.read()) == before
    assert [p.name for p in (folder / "order_day=2024-01-02").glob("*.parquet")] == kept
    first = sorted((folder / "order_day=2024-01-01").glob("*.parquet"))[0]
    seen = [r.customer_id for r in spark.read.parquet(str(first)).select("customer_id").collect()]
    assert seen == sorted(seen)


def test_silver_as_stream(spark, rows, landing, bronze, tmp_path):
    silver = SilverTable(spark, str(tmp_path / "silver"), ORDERS)
    landing.put(order("o1"), order(None))
    run(bronze, landing, tmp_path)
    for _ in range(2):
        query = stream_to_silver(bronze, silver, str(tmp_path / "silver_cp"))
        assert query.awaitTermination(120) and query.exception() is None
    assert rows(silver.read(), "order_id") == [("o1",)]


def test_dimension_as_versions(spark, rows, tmp_path):
    landing = Landing(tmp_path / "landing")
    bronze = BronzeTable(spark, str(tmp_path / "bronze"), CUSTOMERS)
    silver = SilverTable(spark, str(tmp_path / "silver"), CUSTOMERS)
    landing.put({"customer_id": "c1", "email": "a@x.co", "name": "A", "city": "Rome"})
    run(bronze, landing, tmp_path)
    refresh(bronze, silver, salt="s")
    landing.put({"customer_id": "c1", "email": "b@x.co", "name": "A"}, hour="02")
    run(bronze, landing, tmp_path)
    refresh(bronze, silver, salt="s")
    assert rows(silver.read(), "email", "city", F.length("email_salt_key")) == [("b@x.co", None, 64)]
    with pytest.raises(ValueError, match="salt"):
        landing.put({"customer_id": "c2", "email": "b@x.co", "name": "A"}, hour="03")
        run(bronze, landing, tmp_path)
        refresh(bronze, silver)


def test_landing_roundtrip_and_pruning(spark, rows, tmp_path):
    path = str(tmp_path / "orders")
    df = spark.createDataFrame([("a", "2024-01-05T07:00:00Z"), ("b", "2024-02-01T08:00:00Z")], "order_id string, order_date string")
    write_landing(df, path, F.col("order_date").cast("timestamp"))
    assert (tmp_path / "orders" / "year=2024" / "month=01" / "day=05" / "hour=07").exists()
    assert rows(read_landing(spark, ORDERS, path), "order_id", "order_date") == rows(df)
    picked = read_landing_hours(spark, ORDERS, path).where("month = 2")
    assert "PartitionFilters: [isnotnull(month" in picked._jdf.queryExecution().executedPlan().toString()
    assert rows(picked, "order_id") == [("b",)]


def test_drift_in_raw_lines(spark, rows, landing):
    landing.put(order(coupon="x"), order(coupon="y", gift=True))
    lines = read_raw_lines(spark, landing.path)
    assert rows(unknown_json_keys(lines, "value", list(ORDERS.raw))) == [("coupon", 2), ("gift", 1)]


def test_envelope(spark, rows):
    line = json.dumps({"Type": "Notification", "MessageId": "m1", "Timestamp": "t", "Message": json.dumps({"a": 1})})
    df = spark.createDataFrame([(line,)], "value string")
    assert rows(unwrap_envelope(df, "value", "a int")) == [("m1", "t", 1)]


def test_topics_are_complete():
    for topic in TOPICS.values():
        assert set(topic.required) <= set(topic.raw) and set(topic.silver) <= set(topic.raw)
        assert topic.key in topic.not_null


def test_stream_to_silver_keeps_rejects_and_logs_counts(spark, rows, landing, bronze, tmp_path):
    silver, log = SilverTable(spark, str(tmp_path / "silver"), ORDERS), str(tmp_path / "silver_log")
    landing.put(order("o1"), order("o2", order_date="01/02/2024"))
    run(bronze, landing, tmp_path)
    stream_to_silver(bronze, silver, str(tmp_path / "silver_cp"), run_log=log).awaitTermination(120)
    assert rows(silver.read(), "order_id") == [("o1",)]
    assert rows(silver.rejects(bronze), "order_id") == [("o2",)]
    assert rows(read_runs(spark, log), "status", "records_read", "records_written", "records_invalid") == [("success", 2, 1, 1)]


def test_rejects_are_kept_once_after_a_failed_run(spark, rows, landing, bronze, tmp_path, monkeypatch):
    silver, log = SilverTable(spark, str(tmp_path / "silver"), ORDERS), str(tmp_path / "silver_log")
    landing.put(order("o1", order_date="01/02/2024"), order("o2"))
    run(bronze, landing, tmp_path)
    with monkeypatch.context() as patch:
        patch.setattr(SilverTable, "merge", lambda self, latest: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            refresh(bronze, silver, run_log=log)
    landing.put(order("o3"))
    run(bronze, landing, tmp_path)
    refresh(bronze, silver, run_log=log)
    assert rows(silver.rejects(bronze), "order_id") == [("o1",)]
    assert rows(silver.read(), "order_id") == [("o2",), ("o3",)]
    assert sorted(r.status for r in read_runs(spark, log).collect()) == ["failed", "success"]
    silver.optimize(files=1)
    assert rows(silver.read(), "order_id") == [("o2",), ("o3",)]


def test_rejects_of_one_batch_read_in_parts(spark, rows, landing, bronze, tmp_path):
    silver, log = SilverTable(spark, str(tmp_path / "silver"), ORDERS), str(tmp_path / "silver_log")
    landing.put(order("a1", order_date="31/12/2023"), order("a2"))
    landing.put(order("b1", order_date="31/12/2023"), order("b2"))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1")
    try:
        run(bronze, landing, tmp_path)  # one batch of several files
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    more = order("c1", order_date="31/12/2023")
    bronze.valid().limit(1).drop("feed", "batch_id", "_record_status").withColumns(
        {"order_id": F.lit(more["order_id"]), "order_date": F.lit(more["order_date"])}
    ).write.mode("append").parquet(
        f"{bronze.path}/feed={bronze.read().first().feed}/batch_id=0/_record_status=valid"
    )
    for attempt in range(2):  # the second one is a fresh stream that reads all of it again
        query = stream_to_silver(bronze, silver, str(tmp_path / f"silver_cp{attempt}"), run_log=log, max_files=1)
        assert query.awaitTermination(120) and query.exception() is None
        assert rows(silver.rejects(bronze), "order_id") == [("a1",), ("b1",), ("c1",)]
        assert rows(silver.read(), "order_id") == [("a2",), ("b2",)]
    logged = read_runs(spark, log).agg(F.sum("records_read"), F.sum("records_written"), F.sum("records_invalid")).first()
    assert tuple(logged) == (10, 4, 6)


def test_small_batches_of_a_stream_do_not_rewrite_the_days_each(spark, rows, landing, bronze, tmp_path, monkeypatch):
    from quarrylake.sources.tables import PartitionedTable

    for at in range(4):
        landing.put(order(f"o{at}"), order("o9", status=str(at)))
        run(bronze, landing, tmp_path)
    saved, save = [], PartitionedTable._save
    monkeypatch.setattr(PartitionedTable, "_save", lambda self, *about: saved.append(1) or save(self, *about))
    silver = SilverTable(spark, str(tmp_path / "silver"), ORDERS)
    stream_to_silver(bronze, silver, str(tmp_path / "silver_cp"), max_files=1).awaitTermination(120)
    expected = [("o0",), ("o1",), ("o2",), ("o3",), ("o9",)]
    assert rows(silver.read(), "order_id") == expected
    silver.settle()
    assert rows(silver.rows._rows(), "order_id") == expected and len(saved) == 1
    assert rows(silver.read().where("order_id = 'o9'"), "status") == [("3",)]


def test_empty_batches_touch_nothing(spark, rows, landing, bronze, tmp_path):
    silver, log = SilverTable(spark, str(tmp_path / "silver"), ORDERS), str(tmp_path / "silver_log")
    landing.put(order(None))
    run(bronze, landing, tmp_path)
    assert len(refresh(bronze, silver, run_log=log)) == 1  # nothing valid, but the batch is done
    assert refresh(bronze, silver, run_log=log) == {}
    assert not silver.rows.exists() and not (tmp_path / "silver" / "rejects").exists()
    assert rows(read_runs(spark, log), "records_read", "records_written", "records_invalid") == [(0, 0, 0)]


def test_silver_runs_its_input_once(spark, rows, bronze, tmp_path):
    from datetime import datetime

    from quarrylake.streaming.silver import BRONZE_FILE, _merge

    seen = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def counted(value):
        seen.add(1)
        return value

    data = [(f"o{i}", "c", "2024-01-01" if i % 4 else "never", 1.0, "valid", "f", 0) for i in range(20)]
    batch = spark.createDataFrame(data, "order_id string, customer_id string, order_date string, total_amount double, _record_status string, feed string, batch_id int")
    for name in ("status", "payment_method", "shipping_address_id", "_source_file"):
        batch = batch.withColumn(name, F.lit(None).cast("string"))
    batch = batch.withColumns({"_ingestion_timestamp": F.lit(datetime(2024, 1, 1)), BRONZE_FILE: F.lit("file")})
    silver = SilverTable(spark, str(tmp_path / "silver"), ORDERS)
    log = str(tmp_path / "log")
    _merge(batch.withColumn("order_id", counted("order_id")), silver, datetime(2024, 1, 2), None, log, "test")
    assert seen.value == 20 and silver.read().count() == 15
    assert rows(read_runs(spark, log), "records_read", "records_written", "records_invalid") == [(20, 15, 5)]


def test_rescued_fields_name_what_was_lost(spark, rows):
    lines = [
        json.dumps(order("ok")), json.dumps(order("new", gift={"a": 1}, note=None)), json.dumps(order("bad", total_amount="many")),
        json.dumps(order("item", items=[{"product_id": "p", "quantity": "two"}])), "{broken", "[1]", "", None,
    ]
    got = rescued(spark.createDataFrame([(line,) for line in lines], "line string"), "line", ORDERS)
    assert got.columns == [*ORDERS.raw, "record", "rescued"]
    found = {(r.order_id, tuple(r.rescued.items())) for r in got.select("order_id", "rescued").collect()}
    assert found == {
        ("ok", ()), ("new", (("gift", '{"a":1}'),)), ("bad", (("total_amount", "many"),)),
        ("item", (("items", '[{"product_id":"p","quantity":"two"}]'),)),
        (None, (("_corrupt_record", "{broken"),)), (None, (("_corrupt_record", "[1]"),)),
        (None, (("_corrupt_record", ""),)), (None, ()),
    }
    amount = F.try_variant_get("record", "$.total_amount", "string")
    assert rows(got.where("order_id = 'bad'"), amount) == [("many",)]


def test_rescued_parses_a_line_once_however_it_is_filtered(spark):
    lines = spark.range(3).select(F.col("id").cast("string").alias("line"))
    lost = rescued(lines, "line", ORDERS).select("order_id", F.explode("rescued"))
    plan = lost._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(") == 3  # columns, map, and the items alone


def test_drift_of_nested_paths(spark, rows):
    from pyspark.sql.types import StructType

    schema = StructType.fromDDL("id bigint, at string, items array<struct<p:string,q:int>>, place struct<x:double>")
    lines = [
        {"id": 1, "at": "t", "items": [{"p": "a", "q": 1}, {"p": "b", "q": 1.5, "r": [True]}], "place": {"x": 1}},
        {"id": "2", "at": None, "items": {}, "place": {"y": 2}},
        {"id": 3.0, "items": [7]},
    ]
    df = spark.createDataFrame([(json.dumps(line),) for line in lines] + [("{broken",), ("[1]",), (None,)], "line string")
    assert rows(json_drift(df, "line", schema)) == [
        ("at", "missing", None, 1),
        ("id", "retyped", "STRING", 1),
        ("items", "retyped", "OBJECT<>", 1),
        ("items[]", "retyped", "BIGINT", 1),
        ("items[].q", "retyped", "DECIMAL(2,1)", 1),
        ("items[].r", "new", "ARRAY<BOOLEAN>", 1),
        ("items[].r[]", "new", "BOOLEAN", 1),
        ("place", "missing", None, 1),
        ("place.x", "missing", None, 1),
        ("place.y", "new", "BIGINT", 1),
    ]
    assert json_drift(df.where("false"), "line", schema).count() == 0


def _crowded_bronze(bronze, landing, tmp_path):
    """Two batches of ten files each, with unreadable dates, and a batch that is not complete."""
    small = BronzeTable(bronze.spark, bronze.path, ORDERS, 1)
    for batch in (0, 1):
        for n in range(10):
            landing.put(order(f"o{batch}-{n}", order_date="never" if n == 3 else "2024-01-01T10:00:00Z"))
        bulk_load(small, landing.path, "load")
        write_batch(read_landing(bronze.spark, ORDERS, landing.path), 7 + batch, "other", small)
    (tmp_path / "bronze" / "feed=other" / "batch_id=8" / "_SUCCESS").unlink()
    return small


def test_compaction_rewrites_crowded_folders_of_complete_batches(spark, bronze, landing, tmp_path, rows):
    _crowded_bronze(bronze, landing, tmp_path)
    before = rows(bronze.read())
    files = lambda folder: sorted(p.name for p in (tmp_path / "bronze" / folder).rglob("*.parquet"))
    incomplete, kept = files("feed=other/batch_id=8"), files("feed=other/batch_id=7")
    assert bronze.compact(min_files=15) == 1  # 20 files of the load; the other feed's batch has 10
    assert rows(bronze.read()) == before
    assert len(files("feed=load")) < 10 and files("feed=other/batch_id=7") == kept
    assert files("feed=other/batch_id=8") == incomplete
    assert bronze.complete_batches({}) == {"load": 0, "other": 7}
    assert bronze.compact(min_files=15) == 0


def test_compaction_that_was_cut_off_is_finished(spark, bronze, landing, tmp_path, rows, monkeypatch):
    _crowded_bronze(bronze, landing, tmp_path)
    before = rows(bronze.read())
    with monkeypatch.context() as patch:
        patch.setattr(BronzeTable, "finish_compaction", lambda self: None)
        assert bronze.compact(min_files=2) == 2
    assert rows(bronze.read()) == before
    for path in (tmp_path / "bronze" / "feed=load").rglob("*.parquet"):
        path.unlink()  # the overwrite had removed a folder and not yet filled it
    silver = SilverTable(spark, str(tmp_path / "silver"), ORDERS)
    refresh(bronze, silver)
    assert rows(bronze.read()) == before and silver.read().count() == 18
    assert not (tmp_path / "bronze" / "_compacting").exists()


def test_stream_keeps_rejects_once_after_compaction(spark, bronze, landing, tmp_path, rows):
    _crowded_bronze(bronze, landing, tmp_path)
    silver, checkpoint = SilverTable(spark, str(tmp_path / "silver"), ORDERS), str(tmp_path / "scp")
    stream_to_silver(bronze, silver, checkpoint, max_files=12).awaitTermination()
    kept, rejects = rows(silver.read(), "order_id"), rows(silver.rejects(bronze), "feed", "batch_id", "order_id")
    assert len(kept) == 18 and len(rejects) == 5
    assert bronze.compact(min_files=2) == 2
    stream_to_silver(bronze, silver, checkpoint).awaitTermination()
    assert rows(silver.read(), "order_id") == kept
    assert rows(silver.rejects(bronze), "feed", "batch_id", "order_id") == rejects


def test_drift_reads_the_lines_once(spark, tmp_path):
    from pyspark.sql.types import StructType

    path = str(tmp_path / "lines")
    spark.createDataFrame([(json.dumps(order("a")),)], "value string").write.text(path)
    drift = json_drift(spark.read.text(path), "value", StructType.fromDDL(ORDERS.raw_ddl))
    plan = drift._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 1 and plan.count("parseJson(") == 1


def test_rows_are_split_without_a_sort(spark, tmp_path):
    from datetime import datetime

    from quarrylake.sources.landing import parse_lines
    from quarrylake.streaming.silver import _merge

    silver = SilverTable(spark, str(tmp_path / "silver"), ORDERS)
    lines = [(json.dumps(order("fits")),), (json.dumps(order("odd", order_date="soon")),)]
    batch = parse_lines(spark.createDataFrame(lines, "line string"), "line", ORDERS).withColumns(
        {"_ingestion_timestamp": F.lit(datetime(2024, 1, 2)), "_record_status": F.lit("valid"), "feed": F.lit("f"),
         "batch_id": F.lit(0), "_bronze_file": F.lit("a.parquet")}
    )
    _merge(batch, silver, datetime(2024, 1, 2), None, None, "test")
    assert not list((tmp_path / "silver" / "incoming").glob("_fits=*"))
    assert [row.order_id for row in silver.read().collect()] == ["fits"]
    assert [row.order_id for row in spark.read.parquet(f"{silver.path}/rejects").collect()] == ["odd"]


def test_compaction_takes_rows_in_without_a_shuffle(spark, bronze, landing, tmp_path, rows, monkeypatch):
    _crowded_bronze(bronze, landing, tmp_path)
    before = rows(bronze.read())
    with monkeypatch.context() as patch:
        patch.setattr(BronzeTable, "finish_compaction", lambda self: None)
        assert bronze.compact(min_files=2) == 2
    spark.sparkContext.setJobGroup("taken in", "")
    bronze.finish_compaction()
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    tracker = spark.sparkContext.statusTracker()
    stages = [len(tracker.getJobInfo(job).stageIds) for job in tracker.getJobIdsForGroup("taken in")]
    assert stages and set(stages) == {1} and rows(bronze.read()) == before
