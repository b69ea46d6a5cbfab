"""Look back along each key's rows in time order, whatever the size of a key.

A window partitioned by key puts all rows of a key in one task. Here all rows are dealt by ranges
of (key, time, further order) and written once in that order, so a large key fills several ranges,
also if all its rows have one time. A look-back is a scan inside the ranges and one carried row per
range: what a range's first key had last in the ranges before it. Nothing depends on how large a
key is, and there is no list of large keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarrylake.workspace import new_folder

#: Added by ``lay_out``: the key as one value, the range, and the place in the whole order.
PLACES = ["_key", "_range", "_place"]


def hot_keys(df: DataFrame, keys: list[str], min_rows: int) -> DataFrame:
    """All keys with at least ``min_rows`` rows."""
    return df.groupBy(*keys).agg(F.count("*").alias("_rows")).where(F.col("_rows") >= min_rows)


def lay_out(
    df: DataFrame, keys: list[str], time: str, then_by: list[Column] = (), ranges: int | None = None
) -> DataFrame:
    """The rows in order of key, ``time`` and ``then_by``, NULLs first, as a table in the shared folder.

    The order stays right when rows are dropped later, so a chain of look-backs needs it once.
    Rows equal in all of these come in any order. ``ranges`` is the number of tasks that write,
    ``spark.sql.shuffle.partitions`` if not given.
    """
    spark = df.sparkSession
    ranges = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = {"_key": F.struct(*keys), "_at": F.col(time)}
    order |= {f"_by{i}": column for i, column in enumerate(then_by)}
    # one struct as the key: equality on it treats NULL parts as equal; the last part of the order
    # lets rows that are equal in all others lie in several ranges
    rows = df.withColumns(order | {"_tie": F.monotonically_increasing_id()})
    rows = (
        rows.repartitionByRange(ranges, *order, "_tie")
        .sortWithinPartitions(*order, "_tie")
        .drop("_tie", *[name for name in order if name != "_key"])
        .withColumn("_place", F.monotonically_increasing_id())
        .withColumn("_range", F.shiftrightunsigned("_place", 33).cast("int"))
    )
    folder = new_folder(spark, "timeline")
    rows.write.parquet(folder)
    return spark.read.schema(rows.schema).parquet(folder)


def look_back(rows: DataFrame, value: Column, output: str, *, latest_first: bool = False) -> DataFrame:
    """Add the last non-NULL ``value`` before each row of its key, on rows that went through ``lay_out``.

    With ``latest_first`` the walk is reversed, so the result is the next value.
    """

    def walk(column: str) -> Column:
        return F.col(column).desc() if latest_first else F.col(column).asc()

    earlier = Window.unboundedPreceding, -1
    in_range = Window.partitionBy("_range", "_key").orderBy(walk("_place")).rowsBetween(*earlier)
    valued = rows.withColumn("_value", value)
    seen = valued.withColumn("_seen", F.last("_value", ignorenulls=True).over(in_range))

    # of each range the key that is walked first, the one walked last, and the last value met
    begin, end = (F.max_by, F.min_by) if latest_first else (F.min_by, F.max_by)
    met = F.when(F.col("_value").isNotNull(), F.col("_place"))
    edges = valued.groupBy("_range").agg(
        begin("_key", "_place").alias("_enters"),
        end("_key", "_place").alias("_leaves"),
        end(F.struct("_key", "_value"), met).alias("_last"),
    )
    held = F.when(F.col("_last._key") == F.col("_leaves"), F.col("_last._value"))
    steps = edges.select(
        "_range",
        F.explode(
            F.array(
                F.struct(F.lit(0).alias("_leaving"), F.col("_enters").alias("_key"), F.when(F.lit(False), held).alias("_held")),
                F.struct(F.lit(1).alias("_leaving"), F.col("_leaves").alias("_key"), held.alias("_held")),
            )
        ).alias("_step"),
    ).select("_range", "_step.*")
    over_ranges = Window.partitionBy("_key").orderBy(walk("_range"), "_leaving").rowsBetween(*earlier)
    carried = (
        steps.withColumn("_carried", F.last("_held", ignorenulls=True).over(over_ranges))
        .where((F.col("_leaving") == 0) & F.col("_carried").isNotNull())
        .select("_range", "_key", "_carried")
    )
    return seen.join(carried, ["_range", "_key"], "left").select(
        *rows.columns, F.coalesce("_seen", "_carried").alias(output)
    )


def value_before(
    df: DataFrame,
    keys: list[str],
    time: str,
    value: Column,
    output: str,
    *,
    then_by: list[Column] = (),
    latest_first: bool = False,
    ranges: int | None = None,
) -> DataFrame:
    """Add the last non-NULL ``value`` among the rows before each row of its key.

    Rows are ordered by ``time`` and ``then_by`` (given in ascending sense). With
    ``latest_first`` the walk is reversed, so the result is the next value in time.
    """
    found = look_back(lay_out(df, keys, time, then_by, ranges), value, output, latest_first=latest_first)
    return found.drop(*PLACES)
