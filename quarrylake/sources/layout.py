"""How rows lie in files: compaction and clustering by several columns."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_BITS = 8
#: Rows of the sample that the cuts of all columns are taken from.
SAMPLE_ROWS = 20_000
#: Characters of a cut between texts.
CUT_CHARACTERS = 256


def compacted(df: DataFrame) -> DataFrame:
    """The same rows in files of even size (``spark.sql.adaptive.advisoryPartitionSizeInBytes``)."""
    return df.hint("rebalance")


def _cuts(df: DataFrame, columns: list[str]) -> list[list]:
    """For each column up to 255 values, as text, that cut a sample of its rows into equal parts, in order.

    One pass for all columns: the rows with the least random numbers, a bounded number, come to the
    driver in the order of their values. Texts are cut by themselves, not by a number that stands for them.
    """
    sample = df.select(*columns).orderBy(F.rand(7)).limit(SAMPLE_ROWS)
    picked = [F.sort_array(F.collect_list(name)).cast("array<string>").alias(f"_c{i}") for i, name in enumerate(columns)]
    found = []
    for values in sample.agg(*picked).first():
        parts = 2**_BITS
        cuts = [values[len(values) * n // parts] for n in range(1, parts)] if values else []
        found.append([cut[:CUT_CHARACTERS] for cut in cuts])
    return found


def _ranked(df: DataFrame, name: str, cuts: list, rank: str) -> DataFrame:
    """Add how many of the 255 cuts are at or below the value, by binary search; 256 for NULL."""
    found, value = df.withColumn(rank, F.lit(0)), F.col(name)
    if cuts:
        kind = df.schema[name].dataType.simpleString()
        given = F.from_json(F.lit(json.dumps(cuts)), "array<string>").cast(f"array<{kind}>")  # one constant
        # one step per column keeps each expression small and compiled
        for step in (2**n for n in reversed(range(_BITS))):
            above = F.element_at(given, F.col(rank) + step) <= value
            found = found.withColumn(rank, F.col(rank) + F.when(above, step).otherwise(0))
    return found.withColumn(rank, F.when(value.isNull(), 2**_BITS).otherwise(F.col(rank)))


def z_ordered(
    df: DataFrame, columns: list[str], partitions: int, within: str | None = None
) -> DataFrame:
    """Rows that are close in all of ``columns`` come to lie in the same files.

    With ``within``, the order is kept inside each value of that partition column.

    Each column is cut into 256 parts at values of a sample; interleaving the bits of the
    part numbers gives one sort key; rows with equal keys are dealt by a hash, so that a frequent
    value does not end in one task. Parquet's per-file minimum and maximum then skip files for
    filters on any of the columns.
    """
    if len(columns) * (_BITS + 1) > 63:
        raise ValueError(f"more than {63 // (_BITS + 1)} columns do not fit the sort key")
    cut, buckets = df, [f"_b{i}" for i in range(len(columns))]
    for bucket, name, cuts in zip(buckets, columns, _cuts(df, columns)):
        cut = _ranked(cut, name, cuts, bucket)
    key = F.lit(0).cast("bigint")
    for bit in range(_BITS + 1):  # the NULL bucket is number 2**_BITS
        for place, bucket in enumerate(buckets):
            one = F.shiftright(F.col(bucket).cast("bigint"), bit).bitwiseAND(1)
            key = key.bitwiseOR(F.shiftleft(one, bit * len(columns) + place))
    order = [within, "_z"] if within else ["_z"]
    return (
        cut.withColumn("_z", key)
        .withColumn("_tie", F.xxhash64(*df.columns))
        .repartitionByRange(partitions, *order, "_tie")
        .sortWithinPartitions(*order)
        .select(*df.columns)
    )


def clustered(df: DataFrame, column: str, partitions: int) -> DataFrame:
    """Rows ranged and sorted by one column."""
    return df.repartitionByRange(partitions, column).sortWithinPartitions(column)
