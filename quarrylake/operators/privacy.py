"""Hide values and rows from readers, and rotate the salt of hashed keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarrylake.functions.columns import salted_hash

# Fixed value: what a reader without the privilege sees in place of an address.
MASKED_EMAIL = "****@****.com"


def mask_columns(df: DataFrame, masks: dict[str, str], privileged: Column | bool) -> DataFrame:
    """Replace the given columns by a fixed text unless the reader is privileged.

    NULL stays NULL, so a mask does not invent a value.
    """
    allowed = F.lit(privileged) if isinstance(privileged, bool) else privileged
    return df.withColumns(
        {
            name: F.when(allowed | F.col(name).isNull(), F.col(name)).otherwise(F.lit(text))
            for name, text in masks.items()
        }
    )


def filter_rows_for_role(
    df: DataFrame, grants: DataFrame, role: str, column: str
) -> DataFrame:
    """Rows whose ``column`` value is granted to the role in ``grants(role, <column>)``."""
    granted = grants.where(F.col("role") == role).select(column)
    return df.join(granted, column, "left_semi")


def rotate_salt(
    df: DataFrame, columns: list[str], old_salt: str, new_salt: str
) -> DataFrame:
    """Old and new key side by side, so that readers can move over."""
    keys = {}
    for name in columns:
        keys[f"{name}_salt_key"] = salted_hash(old_salt, F.col(name))
        keys[f"{name}_salt_key_new"] = salted_hash(new_salt, F.col(name))
    return df.withColumns(keys)
