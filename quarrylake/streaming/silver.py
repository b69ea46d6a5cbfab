"""Bronze to silver, only what is new: by high-water mark or as a stream."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from quarrylake.operators.quality_rules import VALID
from quarrylake.plans.run_log import log_run
from quarrylake.plans.silver import conform, is_unfit
from quarrylake.schemas import Topic, ddl
from quarrylake.sources.layout import z_ordered
from quarrylake.sources.tables import BucketedTable, Folders, PartitionedTable, listed_files
from quarrylake.streaming.bronze import BronzeTable

#: The bronze file that a row was read from.
BRONZE_FILE = "_bronze_file"
_MARKS = "feed string, batch_id int"
_ADDED = {"_ingestion_timestamp": "timestamp", "_silver_processed_at": "timestamp"}


def since(df: DataFrame, column: str, mark: datetime | None) -> DataFrame:
    """Rows strictly after a high-water mark; all rows if there is none yet."""
    return df if mark is None else df.where(F.col(column) > F.lit(mark).cast("timestamp"))


class SilverTable:
    """A topic's silver table and the marks of the bronze batches it holds.

    Facts with a partition column replace the days a merge touches, dimensions the hash
    buckets of the keys it touches. The marks are stored after the merge: a run that fails in
    between merges the same batches again, which changes nothing.
    """

    def __init__(self, spark: SparkSession, path: str, topic: Topic):
        self.spark, self.topic, self.path = spark, topic, path
        by = topic.partition_by
        if by:
            columns = {**topic.silver, **_ADDED, by: "date"}
            self.rows = PartitionedTable(spark, f"{path}/rows", by, ddl(columns))
        else:
            self.rows = BucketedTable(spark, f"{path}/rows", [topic.key], topic.buckets)
        self._marks = f"{path}/marks"

    def read(self) -> DataFrame:
        return self.rows.read()

    def merge(self, latest: DataFrame) -> None:
        self.rows.merge(self._dealt(latest), [self.topic.key], "_ingestion_timestamp")

    def put(self, latest: DataFrame) -> None:
        """Merge one of many small batches: facts take it into their days later, at the latest by ``settle``."""
        self.rows.put(self._dealt(latest), [self.topic.key], "_ingestion_timestamp")

    def settle(self) -> None:
        self.rows.settle()

    def _dealt(self, latest: DataFrame) -> DataFrame:
        by = self.topic.partition_by
        return latest.withColumn(by, F.to_date(self.topic.event_time)) if by else latest

    def optimize(self, files: int, partitions: list | None = None) -> None:
        """Rewrite the rows so that filters on the topic's cluster columns skip files.

        A partitioned table rewrites the given partitions, or all of them.
        """
        columns, by = list(self.topic.cluster_by), self.topic.partition_by
        if by:
            if partitions is None:
                partitions = [row[0] for row in self.rows.partitions().collect()]
            self.rows.rewrite(
                partitions, lambda old: z_ordered(old, columns, files, within=by), arranged=True
            )
        else:
            self.rows.arrange(lambda old: z_ordered(old, columns, files, within=BucketedTable.BUCKET))

    def keep_rejects(self, rows: DataFrame, bronze: BronzeTable | None = None) -> None:
        """Store bronze rows silver cannot hold, by the bronze file they lie in (``BRONZE_FILE``).

        A bronze batch may come in several runs, each with other files of it: rows of a file replace
        what was stored of that file, and rows of the batch's other files stay, unless compaction of
        ``bronze`` has taken their file's rows into another one. Only the batches of
        ``rows`` are rewritten, by Spark's dynamic partition overwrite.
        """
        stored = f"{self.path}/rejects"
        if Folders(self.spark, self.path).exists(stored):
            batches = rows.select("feed", "batch_id").distinct()
            files = rows.select(BRONZE_FILE).distinct()
            others = (
                self.spark.read.schema(rows.schema).parquet(stored)
                .join(batches, ["feed", "batch_id"], "left_semi")
                .join(files, BRONZE_FILE, "left_anti")
            )
            if bronze:
                name = F.element_at(F.split(BRONZE_FILE, "/"), -1)  # file names are unique
                there = listed_files(self.spark, bronze.path).select(F.element_at(F.split("path", "/"), -1).alias("_there"))
                others = others.join(there, name == F.col("_there"), "left_semi")
            rows = rows.unionByName(others)
        (
            rows.hint("rebalance", F.col("feed"), F.col("batch_id"))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("feed", "batch_id")
            .parquet(stored)
        )

    def rejects(self, bronze: BronzeTable) -> DataFrame:
        return self.spark.read.schema(bronze.schema).parquet(f"{self.path}/rejects")

    def marks(self) -> dict[str, int]:
        """The last batch merged of each feed: one entry per checkpoint ever used."""
        if not Folders(self.spark, self.path).exists(self._marks):
            return {}
        stored = self.spark.read.schema(_MARKS).parquet(self._marks)
        return dict(stored.groupBy("feed").agg(F.max("batch_id")).collect())

    def add_marks(self, marks: dict[str, int]) -> None:
        if marks:
            rows = self.spark.createDataFrame(list(marks.items()), _MARKS)
            rows.coalesce(1).write.mode("append").parquet(self._marks)


def _between(marks: dict[str, int], up_to: dict[str, int]) -> Column:
    """A filter on folder columns only, so merged batches are not even opened."""
    wanted = F.lit(False)
    for feed, last in up_to.items():
        first = marks.get(feed, -1) + 1
        wanted = wanted | ((F.col("feed") == feed) & F.col("batch_id").between(first, last))
    return wanted


def refresh(
    bronze: BronzeTable, silver: SilverTable, salt: str | None = None, run_log: str | None = None
) -> dict[str, int]:
    """Merge the bronze batches that silver does not hold yet; returns the new marks."""
    bronze.finish_compaction()
    started, marks = datetime.now(timezone.utc), silver.marks()
    batches = bronze.complete_batches(after=marks)
    if not batches:
        return {}
    new = _with_file(bronze.valid().where(_between(marks, batches)))
    _merge(new, silver, started, salt, run_log, "refresh", bronze)
    silver.add_marks(batches)
    return batches


def _with_file(bronze_rows: DataFrame) -> DataFrame:
    return bronze_rows.select("*", F.col("_metadata.file_path").alias(BRONZE_FILE))


def _merge(
    new: DataFrame, silver: SilverTable, started: datetime, salt: str | None, run_log: str | None, job: str,
    bronze: BronzeTable | None = None, one_of_many: bool = False,
) -> None:
    """Store what silver cannot hold, merge the rest, and log the run either way.

    The input runs once: it is written aside, split into rows that fit and rows that do not, and
    counted by that write. Of the rows read, those written went into the merge, the invalid ones
    to the rejects. Without rows neither table is touched. Rows that fit are written without the columns
    that silver does not have.
    """
    about = dict(
        run_id=f"silver/{silver.topic.name}/{started.isoformat()}", topic=silver.topic.name, layer="silver",
        job=job, started=started,
    )
    try:
        aside, counts = f"{silver.path}/incoming", Observation()
        split = new.withColumn("_fits", ~is_unfit(silver.topic)).observe(
            counts, F.count("*").alias("read"), F.count_if(~F.col("_fits")).alias("unfit")
        )
        unread = [name for name in silver.topic.raw if name not in silver.topic.silver and name in split.columns]
        split = split.withColumns({name: F.when(~F.col("_fits"), F.col(name)) for name in unread})
        # a column, not a folder: a write by folders sorts all rows of a task
        split.write.mode("overwrite").parquet(aside)
        read, invalid = counts.get["read"], counts.get["unfit"]
        rows = silver.spark.read.schema(split.schema).parquet(aside)
        if invalid:
            silver.keep_rejects(rows.where(~F.col("_fits")).drop("_fits"), bronze)
        if read > invalid:
            fitting = rows.where("_fits").drop("_fits", BRONZE_FILE)
            rows = conform(fitting, silver.topic, started, salt)
            silver.put(rows) if one_of_many else silver.merge(rows)
    except Exception as failure:
        if run_log:
            log_run(silver.spark, run_log, status="failed", error=str(failure), **about)
        raise
    if run_log:
        log_run(
            silver.spark, run_log, status="success", read=read, written=read - invalid, invalid=invalid, **about
        )


def stream_to_silver(
    bronze: BronzeTable, silver: SilverTable, checkpoint: str, salt: str | None = None,
    run_log: str | None = None, max_files: int = 1000,
) -> StreamingQuery:
    """The same as a stream over the bronze files, one merge per batch.

    Facts hold each batch from its end on, but take several together into their days (see ``PartitionedTable.put``);
    ``SilverTable.settle`` takes in what is left.
    """
    bronze.finish_compaction()
    spark = bronze.spark
    rows = (
        spark.readStream.schema(bronze.schema)
        .option("maxFilesPerTrigger", max_files)
        .parquet(bronze.path)
    )
    rows = _with_file(rows).where(F.col("_record_status") == VALID)

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        _merge(batch, silver, datetime.now(timezone.utc), salt, run_log, "stream", bronze, one_of_many=True)

    return (
        rows.writeStream.foreachBatch(on_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
