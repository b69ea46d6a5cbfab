"""Wide tables: group columns into structs, or split a table in two."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def group_columns(df: DataFrame, groups: dict[str, list[str]]) -> DataFrame:
    """Put each list of columns into one struct column of the given name."""
    grouped = {name for members in groups.values() for name in members}
    kept = [name for name in df.columns if name not in grouped]
    return df.select(*kept, *[F.struct(*members).alias(name) for name, members in groups.items()])


def split_columns(df: DataFrame, keys: list[str], core: list[str]) -> tuple[DataFrame, DataFrame]:
    """A narrow table of often-read columns and one of the rest, sharing the key."""
    rest = [name for name in df.columns if name not in {*keys, *core}]
    return df.select(*keys, *core), df.select(*keys, *rest)
