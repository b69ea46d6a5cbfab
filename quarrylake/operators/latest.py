"""Keep the newest row, or the newest delivery, of each key."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, MapType, VariantType


def _orderable(kind: DataType) -> bool:
    text = kind.simpleString()
    return not isinstance(kind, (MapType, VariantType)) and "map<" not in text


def keep_latest(df: DataFrame, keys: list[str], newest_by: list[str]) -> DataFrame:
    """One row per key: the greatest by ``newest_by``, NULL being the oldest.

    Ties go to the remaining columns in their order, so the survivor does not
    depend on how rows are spread. The rank filter lets Spark cut each key to one
    row before the shuffle (WindowGroupLimit), which also tames a hot key.
    """
    named = {*keys, *newest_by}
    tie_break = [f.name for f in df.schema if f.name not in named and _orderable(f.dataType)]
    order = [F.col(name).desc_nulls_last() for name in [*newest_by, *tie_break]]
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).where(F.col("_rank") == 1).drop("_rank")


def keep_latest_delivery(df: DataFrame, keys: list[str], version: str) -> DataFrame:
    """All rows that carry their key's greatest version.

    For keys that arrive as several rows per delivery. The newest version per key
    is a pre-aggregated maximum, so no key is gathered in one task; rows of a hot
    key stay spread by the join's skew split.
    """
    newest = df.groupBy(*keys).agg(F.max(version).alias("_newest"))
    same_key = [df[name].eqNullSafe(newest[name]) for name in keys]
    return df.join(
        newest, [*same_key, df[version].eqNullSafe(newest["_newest"])], "left_semi"
    )
