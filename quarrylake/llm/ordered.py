"""Exact ranks of rows without a task that sees a whole group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarrylake.llm.common import written


def ranked(df: DataFrame, within: str, order: list[str | Column], purpose: str) -> DataFrame:
    """``df`` with ``rank`` (from 0 in each group, by ``order``) and ``members`` (rows of the group).

    Rows are dealt by ranges of (group, order) and sorted in their range, so a group of any
    size spreads over tasks; only one row per group and range is summed up to offsets. Rows
    that are equal in ``order`` get consecutive ranks; a row number ends the range key, so many
    equal rows do not share a task either. ``within`` must not be null. Columns named ``_tie``,
    ``_place``, ``_range``, ``rank`` and ``members`` are replaced. An empty table stays empty.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = [within, *order, "_tie"]
    placed = (
        df.withColumn("_tie", F.monotonically_increasing_id())
        .repartitionByRange(parts, *keys)
        .sortWithinPartitions(*keys)
        .withColumn("_place", F.monotonically_increasing_id())
        .withColumn("_range", F.shiftrightunsigned("_place", 33).cast("int"))
        .drop("_tie")
    )
    placed = written(placed, purpose)
    earlier = Window.partitionBy(within).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = (
        placed.groupBy(within, "_range")
        .agg(F.min("_place").alias("_first"), F.count(F.lit(1)).alias("_rows"))
        .withColumn("_before", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)))
        .withColumn("members", F.sum("_rows").over(Window.partitionBy(within)))
    )
    return (
        placed.join(ranges, [within, "_range"])
        .withColumn("rank", F.col("_place") - F.col("_first") + F.col("_before"))
        .drop("_place", "_range", "_first", "_rows", "_before")
    )
