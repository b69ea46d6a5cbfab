"""One row per job run, appended when the run ends."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession

from quarrylake.schemas import ddl

# The columns of the run log.
RUN_LOG = {
    "run_id": "string",
    "topic_name": "string",
    "layer": "string",
    "job_name": "string",
    "start_time": "timestamp",
    "end_time": "timestamp",
    "status": "string",
    "records_read": "bigint",
    "records_written": "bigint",
    "records_invalid": "bigint",
    "error_message": "string",
    "_updated_at": "timestamp",
}


def log_run(
    spark: SparkSession, path: str, *, run_id: str, topic: str, layer: str, job: str,
    started: datetime, status: str, read: int = 0, written: int = 0, invalid: int = 0,
    error: str | None = None, ended: datetime | None = None,
) -> None:
    ended = ended or datetime.now(timezone.utc)
    row = (
        run_id, topic, layer, job, started, ended, status, read, written, invalid,
        error, ended,
    )
    spark.createDataFrame([row], ddl(RUN_LOG)).coalesce(1).write.mode("append").parquet(path)


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(ddl(RUN_LOG)).parquet(path)
