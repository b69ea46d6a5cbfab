"""Column expressions used across the layers. All of them stay in the JVM."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SALT_SEPARATOR = "|"


def is_blank(column: Column) -> Column:
    """True for NULL, for an empty text and for a text of spaces only."""
    return F.coalesce(F.trim(column.cast("string")), F.lit("")) == ""


def salted_hash(salt: str, *columns: Column) -> Column:
    """64 hex digits over the salt and the given values, NULL counting as ''.

    The separator may occur inside values, so with several columns two different
    rows can share a key; a single column is safe.
    """
    parts = [F.coalesce(column.cast("string"), F.lit("")) for column in columns]
    return F.sha2(F.concat_ws(SALT_SEPARATOR, F.lit(salt), *parts), 256)


def generate_salt_key(
    df: DataFrame, columns: list[str], output_column: str = "salt_key", *, salt: str
) -> DataFrame:
    """Add a salted SHA-256 key. The salt has no default: it must be a real secret."""
    return df.withColumn(output_column, salted_hash(salt, *[F.col(name) for name in columns]))
