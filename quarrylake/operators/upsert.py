"""Merge changed rows into a keyed frame: (target, source) -> new target."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_NULL_KEY_SPREAD = 4096


def _spread_null_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows without a key match nothing; a salt keeps them out of one single task."""
    any_null = F.lit(False)
    for name in keys:
        any_null = any_null | F.col(name).isNull()
    row_hash = F.pmod(F.xxhash64(*df.columns), F.lit(_NULL_KEY_SPREAD))
    return df.withColumn("_salt", F.when(any_null, row_hash).otherwise(F.lit(0)))


def _side(df: DataFrame, keys: list[str], name: str) -> DataFrame:
    salted = _spread_null_keys(df, keys)
    return salted.select(*keys, "_salt", F.struct(*df.columns).alias(name))


def upsert(target: DataFrame, source: DataFrame, keys: list[str], version: str) -> DataFrame:
    """Insert new keys; replace a target row by a strictly newer source row.

    Equal, older or NULL versions on either side keep the target row. Rows with a
    NULL key never match: both sides' rows stay. A replacing row also overwrites
    with its NULLs. Columns only one side has are kept (NULL where unknown). The
    source must hold each key once; ``keep_latest`` sees to that.
    """
    old, new = _side(target, keys, "_old"), _side(source, keys, "_new")
    both = old.join(new, [*keys, "_salt"], "full_outer")
    # a side's struct is NULL only where that side has no row
    take_new = F.col("_old").isNull() | F.coalesce(
        F.col(f"_new.{version}") > F.col(f"_old.{version}"), F.lit(False)
    )

    def chosen(name: str) -> Column:
        if name not in source.columns:
            return F.col(f"_old.{name}")
        incoming = F.when(take_new, F.col(f"_new.{name}"))
        return incoming.otherwise(F.col(f"_old.{name}")) if name in target.columns else incoming

    added = [name for name in source.columns if name not in target.columns]
    return both.select(*[chosen(name).alias(name) for name in [*target.columns, *added]])


def update_columns(
    target: DataFrame, source: DataFrame, keys: list[str], columns: list[str]
) -> DataFrame:
    """Set ``columns`` from the matching source row; never insert.

    Missing columns are added to the target first. A match sets the source value
    even if it is NULL; without a match the target value stays.
    """
    patch = source.select(*keys, F.struct(*columns).alias("_patch"))
    joined = target.join(patch, keys, "left")
    matched = F.col("_patch").isNotNull()
    outputs = []
    for name in [*target.columns, *[c for c in columns if c not in target.columns]]:
        if name not in columns:
            outputs.append(F.col(name))
            continue
        value = F.when(matched, F.col(f"_patch.{name}"))
        outputs.append((value.otherwise(F.col(name)) if name in target.columns else value).alias(name))
    return joined.select(*outputs)
