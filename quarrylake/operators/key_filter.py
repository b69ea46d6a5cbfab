"""Lists of hashed keys: which partitions can hold a key, without reading their keys.

A partition's list holds the 64-bit hash of each of its keys once, 8 bytes a key. A key that a
partition holds is always found. One that it does not hold is found only if its hash is another
key's, which costs a look at that partition and nothing else.

Source and lists meet by equal hashes, so the work grows with keys and hashes, not with keys
times partitions as it does where every key asks a bitmap of every partition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FILTER_COLUMNS = "key_hash bigint"


def _hash(keys: list[str]) -> Column:
    return F.xxhash64(*[F.col(name).cast("string") for name in keys])


def key_filters(rows: DataFrame, keys: list[str], partition: str) -> DataFrame:
    """(partition, key_hash): the hashes of every partition's keys.

    Rows with a NULL key match nothing and are left out.
    """
    return rows.dropna(subset=keys).select(partition, _hash(keys).alias("key_hash")).distinct()


def meeting(filters: DataFrame, source: DataFrame, keys: list[str], partition: str) -> DataFrame:
    """The partitions that can hold one of the source's keys."""
    asked = source.dropna(subset=keys).select(_hash(keys).alias("key_hash"))
    return filters.join(asked, "key_hash", "left_semi").select(partition).distinct()
