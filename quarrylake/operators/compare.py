"""Compare two versions of a table: change feed and reconciliation.

Large tables that differ in little are narrowed first (``differing_rows``): checksums of partitions
and of branches of the key space say where rows differ, and only those rows are compared by key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Branches of the key space: a bound on the rows of a list of branches.
BRANCHES = 1 << 16


def _common_columns(left: DataFrame, right: DataFrame) -> list[str]:
    """The columns of both sides; leaving a one-sided column out would hide its changes."""
    lone = set(left.columns) ^ set(right.columns)
    if lone:
        raise ValueError(f"columns on one side only: {sorted(lone)}")
    return left.columns


def snapshot_diff(before: DataFrame, after: DataFrame, keys: list[str]) -> DataFrame:
    """Change feed between two snapshots with unique, non-NULL keys.

    ``change_type`` is insert, update or delete; the row shown is the new one, for
    a delete the old one. Unchanged rows are left out. Values are compared
    themselves, not by hash. A column that one side lacks is an error.
    """
    columns = _common_columns(before, after)
    old = before.select(*keys, F.struct(*columns).alias("_old"))
    new = after.select(*keys, F.struct(*columns).alias("_new"))
    kind = (
        F.when(F.col("_old").isNull(), "insert")
        .when(F.col("_new").isNull(), "delete")
        .when(~F.col("_old").eqNullSafe(F.col("_new")), "update")
    )
    return (
        old.join(new, keys, "full_outer")
        .select(kind.alias("change_type"), F.coalesce("_new", "_old").alias("_row"))
        .where(F.col("change_type").isNotNull())
        .select("change_type", "_row.*")
    )


def _state(columns: list[str]) -> Column:
    """Number of rows and checksum of a group, whatever the order of its rows."""
    # the hash skips NULLs, so each column also says whether it is one
    parts = [part for name in columns for part in (F.col(name), F.col(name).isNull())]
    # decimal: a sum of 64-bit hashes leaves the 64-bit range
    checksum = F.sum(F.xxhash64(*parts).cast("decimal(20,0)"))
    return F.struct(F.count("*").alias("rows"), checksum.alias("sum"))


def _differing(source: DataFrame, target: DataFrame, by: Column, columns: list[str]) -> DataFrame:
    """The groups, as ``_branch``, whose rows are not the same on both sides."""
    sides = [
        df.groupBy(by.alias("_branch")).agg(_state(columns).alias(name))
        for df, name in ((source, "_source"), (target, "_target"))
    ]
    same_group = F.col("a._branch").eqNullSafe(F.col("b._branch"))
    both = sides[0].alias("a").join(sides[1].alias("b"), same_group, "full_outer")
    group = F.when(F.col("_source").isNull(), F.col("b._branch")).otherwise(F.col("a._branch"))
    return both.where(~F.col("_source").eqNullSafe(F.col("_target"))).select(group.alias("_branch"))


def differing_rows(
    source: DataFrame, target: DataFrame, keys: list[str], partition: str | None = None, branches: int = BRANCHES
) -> tuple[DataFrame, DataFrame]:
    """Both sides without the parts of the key space that hold the same rows on both.

    A tree of checksums, from the top: with ``partition``, a column that both tables are stored by and
    that follows from the key, first one checksum per partition, and only partitions that differ are
    read again. Then one per branch, a hash of the key; rows of branches that differ are kept. Every step
    combines its sums before the shuffle, so equal rows are read but never shuffled. Each key that differs
    is kept on both sides with all its rows, so ``snapshot_diff`` and ``reconcile_keys`` find the same in
    what is left. Equal parts are told by count and a sum of 64-bit hashes. The sides are read
    several times and must read the same each time. Sides without rows and NULL keys are fine.
    """
    columns = _common_columns(source, target)
    if partition:
        # as many values at most as the tables have folders
        changed = [row[0] for row in _differing(source, target, F.col(partition), columns).collect()]
        known = F.col(partition).isin([value for value in changed if value is not None])
        wanted = known | F.col(partition).isNull() if None in changed else known
        source, target = source.where(wanted), target.where(wanted)
    # keys of several number types have one text
    parts = [part for name in keys for part in (F.col(name).cast("string"), F.col(name).isNull())]
    branch = F.pmod(F.xxhash64(*parts), F.lit(branches))
    differing = F.broadcast(_differing(source, target, branch, columns))  # ``branches`` rows at most
    left, right = (df.join(differing, branch == F.col("_branch"), "left_semi") for df in (source, target))
    return left, right


def _fingerprints(source: DataFrame, target: DataFrame, keys: list[str]) -> DataFrame:
    """One row per key of either side: row count and checksum of both.

    The key is one struct, so a NULL key part equals a NULL key part.
    """
    state = _state(_common_columns(source, target))
    sides = [
        df.groupBy(F.struct(*keys).alias("_key")).agg(state.alias(name))
        for df, name in ((source, "_source"), (target, "_target"))
    ]
    return sides[0].join(sides[1], "_key", "full_outer")


def reconcile_keys(source: DataFrame, target: DataFrame, keys: list[str]) -> DataFrame:
    """Per key that differs: row counts on both sides and what is wrong.

    Both sides are reduced to one row per key first, so repeated keys cost no more
    than others.
    """
    finding = (
        F.when(F.col("_target").isNull(), "missing_in_target")
        .when(F.col("_source").isNull(), "extra_in_target")
        .when(F.col("_source.rows") != F.col("_target.rows"), "row_count")
        .when(F.col("_source.sum") != F.col("_target.sum"), "content")
    )
    return (
        _fingerprints(source, target, keys)
        .withColumns(
            {
                "finding": finding,
                "source_rows": F.coalesce("_source.rows", F.lit(0)),
                "target_rows": F.coalesce("_target.rows", F.lit(0)),
            }
        )
        .where(F.col("finding").isNotNull())
        .select("_key.*", "finding", "source_rows", "target_rows")
    )


def reconcile(source: DataFrame, target: DataFrame, keys: list[str]) -> DataFrame:
    """One row: row counts of both sides and the number of keys per finding."""
    both_there = F.col("_source").isNotNull() & F.col("_target").isNotNull()
    differs = ~F.col("_source").eqNullSafe(F.col("_target"))
    return _fingerprints(source, target, keys).agg(
        F.coalesce(F.sum("_source.rows"), F.lit(0)).alias("source_rows"),
        F.coalesce(F.sum("_target.rows"), F.lit(0)).alias("target_rows"),
        F.count_if(F.col("_target").isNull()).alias("missing_keys"),
        F.count_if(F.col("_source").isNull()).alias("extra_keys"),
        F.count_if(both_there & differs).alias("changed_keys"),
    )
