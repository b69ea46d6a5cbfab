"""Bronze to silver: typed, one row per key, with hashed personal data."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarrylake.functions.columns import is_blank, salted_hash
from quarrylake.operators.latest import keep_latest
from quarrylake.operators.quality_rules import VALID
from quarrylake.schemas import Topic


def _typed(bronze: DataFrame, topic: Topic) -> list[Column]:
    """The silver columns; a value that does not fit its type becomes NULL."""
    return [F.col(name).try_cast(kind).alias(name) for name, kind in topic.silver.items()]


def is_unfit(topic: Topic) -> Column:
    """True where a value is lost by its cast or a mandatory column is empty."""
    unfit = F.lit(False)
    for name, kind in topic.silver.items():
        lost = F.col(name).try_cast(kind).isNull()
        if kind != "string" and topic.raw[name] != kind:
            unfit = unfit | (lost & ~is_blank(F.col(name)))
        if name in topic.not_null:
            unfit = unfit | lost
    return unfit


def rejects(bronze: DataFrame, topic: Topic) -> DataFrame:
    """Valid bronze rows that silver cannot hold, in their bronze shape."""
    return bronze.where((F.col("_record_status") == VALID) & is_unfit(topic))


def conform(
    bronze: DataFrame, topic: Topic, processed_at: datetime, salt: str | None = None
) -> DataFrame:
    """The newest valid row per key, typed; salted columns get a ``_salt_key``.

    Newest is by ingestion time, then the topic's own time, then the source file.
    The hashes are computed after the reduction, once per key.
    """
    extras = [name for name in ("_source_file",) if name in bronze.columns]
    typed = bronze.where((F.col("_record_status") == VALID) & ~is_unfit(topic)).select(
        *_typed(bronze, topic), "_ingestion_timestamp", *extras
    )
    latest = keep_latest(
        typed, [topic.key], ["_ingestion_timestamp", topic.event_time, *extras]
    )
    if topic.salted and not salt:
        raise ValueError(f"{topic.name} holds personal data: a salt is required")
    hashed = [salted_hash(salt, F.col(c)).alias(f"{c}_salt_key") for c in topic.salted]
    return latest.select(
        *topic.silver,
        *hashed,
        "_ingestion_timestamp",
        F.lit(processed_at).cast("timestamp").alias("_silver_processed_at"),
    )
