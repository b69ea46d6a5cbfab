"""Landing files to bronze: a stream that validates, stamps and splits each batch."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from quarrylake.operators.quality_rules import (
    INVALID,
    VALID,
    add_audit_columns,
    validate_required_fields,
)
from quarrylake.plans.run_log import log_run
from quarrylake.schemas import Topic
from quarrylake.sources.landing import CORRUPT_COLUMN, read_landing, stream_landing
from quarrylake.sources.tables import SUCCESS, Folders, listed_files


CORRUPT_RULE = "corrupt_record"
#: Files below this size are small.
SMALL_BYTES = 32 << 20
#: Bytes of a row group: a run that reads few files has several tasks for each.
ROW_GROUP_BYTES = 8 << 20


_FOLDERS = ["feed", "batch_id", "_record_status"]


@dataclass(frozen=True)
class BronzeTable:
    """Where a topic's bronze rows lie.

    Folders are ``feed=<stream>/batch_id=<n>/_record_status=<valid|invalid>``. A batch
    that is run again overwrites its own folder, so a retry never doubles rows. The
    feed is the stream's own id: a fresh checkpoint starts a new feed instead of
    overwriting batch 0 of the old one. With ``max_rows_per_file`` a batch that is much
    larger than the others does not end in a few large files.
    """

    spark: SparkSession
    path: str
    topic: Topic
    max_rows_per_file: int = 0

    def batch_folder(self, feed: str, batch_id: int) -> str:
        return f"{self.path}/feed={feed}/batch_id={batch_id}"

    @property
    def schema(self) -> str:
        """Fixed columns: planning a read opens no file, and old files may lack some."""
        return (
            f"{self.topic.bronze_ddl}, `{CORRUPT_COLUMN}` string, `feed` string, `batch_id` int"
        )

    def read(self) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(self.path)

    def valid(self) -> DataFrame:
        return self.read().where(F.col("_record_status") == VALID)

    def invalid(self) -> DataFrame:
        return self.read().where(F.col("_record_status") == INVALID)

    @property
    def _compacting(self) -> str:
        return f"{self.path}/_compacting"

    def compact(self, small_bytes: int = SMALL_BYTES, min_files: int = 8) -> int:
        """Rewrite the folders of complete batches that hold ``min_files`` small files or more; returns their number.

        Which ones is told by a listing. Their rows are written aside in files of even size and then taken in by
        dynamic partition overwrite; other folders are not touched, and a batch stays the same batch. What is
        completely written aside counts: a compaction that was cut off is finished by the next one or by the
        next ``refresh`` or stream to silver. To be run while no one reads or writes the table. ``refresh`` goes by batch and does not
        read compacted batches again; a stream takes their files for new ones and merges the same
        rows once more, which changes nothing.
        """
        self.finish_compaction()
        last = self.complete_batches(after={})
        if not last:
            return 0
        files = listed_files(self.spark, self.path)
        batch = F.regexp_extract("folder", "batch_id=([0-9]+)", 1).cast("int")
        feed = F.regexp_extract("folder", "^feed=([^/]+)/", 1)
        small = files.groupBy("folder").agg(F.count_if(F.col("length") < small_bytes).alias("small"))
        crowded = small.where(F.col("small") >= min_files).select("folder", feed.alias("feed"), batch.alias("batch"))
        # a part of the folder list, which the driver holds anyway
        folders = [row.folder for row in crowded.collect() if row.batch <= last.get(row.feed, -1)]
        if not folders:
            return 0
        folders_of = self.spark.read.schema(self.schema).option("basePath", self.path)
        rows = folders_of.parquet(*[f"{self.path}/{folder}" for folder in folders])
        (
            rows.hint("rebalance", *[F.col(name) for name in _FOLDERS])
            .write.mode("overwrite")
            .option("maxRecordsPerFile", self.max_rows_per_file)
            .partitionBy(*_FOLDERS)
            .parquet(self._compacting)
        )
        self.finish_compaction()
        return len(folders)

    def finish_compaction(self) -> None:
        """Take what a compaction has written aside into the table; may be cut off and repeated."""
        folders = Folders(self.spark, self.path)
        if not folders.exists(f"{self._compacting}/{SUCCESS}"):
            return
        # dealt by folder in files of even size already, so they are not shuffled again
        staged = self.spark.read.schema(self.schema).parquet(self._compacting)
        (
            staged.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .option("maxRecordsPerFile", self.max_rows_per_file)
            .option("parquet.block.size", ROW_GROUP_BYTES)
            .partitionBy(*_FOLDERS)
            .parquet(self.path)
        )
        folders.drop(self._compacting)

    def complete_batches(self, after: dict[str, int]) -> dict[str, int]:
        """The last complete batch per feed, for feeds with one later than ``after``.

        Looks at folder names only. A batch still being written has no success
        marker yet and is left for the next call; batches of a feed follow each
        other, so every batch up to a complete one is complete.
        """
        folders, last = Folders(self.spark, self.path), {}
        for feed in _values(folders.names(self.path), "feed"):
            batches = map(int, _values(folders.names(f"{self.path}/feed={feed}"), "batch_id"))
            for batch in sorted((b for b in batches if b > after.get(feed, -1)), reverse=True):
                if folders.exists(f"{self.batch_folder(feed, batch)}/{SUCCESS}"):
                    last[feed] = batch
                    break
        return last


def _values(names: list[str], column: str) -> list[str]:
    return [name.split("=", 1)[1] for name in names if name.startswith(f"{column}=")]


def _half_read_as_invalid(checked: DataFrame) -> DataFrame:
    """A line that was read in part, with a value that does not fit its type, is invalid."""
    if CORRUPT_COLUMN not in checked.columns:
        return checked
    half = F.col(CORRUPT_COLUMN).isNotNull()
    found = F.concat_ws(",", F.nullif("_validation_errors", F.lit("")), F.lit(CORRUPT_RULE))
    return checked.withColumns(
        {
            "_validation_errors": F.when(half, found).otherwise(F.col("_validation_errors")),
            "_record_status": F.when(half, INVALID).otherwise(F.col("_record_status")),
        }
    )


def write_batch(
    batch: DataFrame, batch_id: int, feed: str, table: BronzeTable, run_log: str | None = None
) -> None:
    """One pass over the batch: both outputs are one write, split by folder.

    The log's counts come from the files just written, whose footers hold them.
    """
    started = datetime.now(timezone.utc)
    spark, folder = batch.sparkSession, table.batch_folder(feed, batch_id)
    about = dict(
        run_id=f"{feed}/{batch_id}", topic=table.topic.name, layer="bronze", job="ingest",
        started=started,
    )
    checked = validate_required_fields(add_audit_columns(batch, started), table.topic.required)
    checked = _half_read_as_invalid(checked)
    try:
        (
            checked.hint("rebalance", F.col("_record_status"))
            .write.mode("overwrite")
            .option("maxRecordsPerFile", table.max_rows_per_file)
            .option("parquet.block.size", ROW_GROUP_BYTES)
            .partitionBy("_record_status")
            .parquet(folder)
        )
    except Exception as failure:
        if run_log:
            log_run(spark, run_log, status="failed", error=str(failure), **about)
        raise
    if run_log:
        written = spark.read.schema(table.schema).parquet(folder)
        rows = dict(written.groupBy("_record_status").count().collect())
        valid, invalid = rows.get(VALID, 0), rows.get(INVALID, 0)
        log_run(
            spark, run_log, status="success", read=valid + invalid, written=valid,
            invalid=invalid, **about,
        )


def bulk_load(table: BronzeTable, landing: str, load: str, run_log: str | None = None) -> None:
    """Load landed history in one batch job, past the stream's files-per-batch limit.

    ``load`` names the load; repeating it replaces it.
    """
    write_batch(read_landing(table.spark, table.topic, landing), 0, load, table, run_log)


def ingest(
    table: BronzeTable,
    landing: str,
    checkpoint: str,
    *,
    max_files: int = 1000,
    every: str | None = None,
    run_log: str | None = None,
) -> StreamingQuery:
    """Start the stream. It reads what has landed and stops, or runs ``every`` interval."""
    spark = table.spark

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        feed = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        write_batch(batch, batch_id, feed, table, run_log)

    trigger = {"processingTime": every} if every else {"availableNow": True}
    return (
        stream_landing(spark, table.topic, landing, max_files)
        .writeStream.foreachBatch(on_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )
