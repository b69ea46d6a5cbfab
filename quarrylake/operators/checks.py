"""Table-level quality checks, all reported in one shape."""

from __future__ import annotations

from datetime import datetime
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

from quarrylake.operators.quality_rules import INVALID

RESULT_COLUMNS = [
    "check_id",
    "run_id",
    "table_name",
    "check_type",
    "check_description",
    "check_result",
    "expected_value",
    "actual_value",
    "threshold",
    "checked_at",
]


class Check(NamedTuple):
    """One aggregate over the table, with what it must be."""

    check_type: str
    description: str
    actual: Column
    passed: Column
    expected: str
    threshold: float | None = None
    severity: str = "fail"


def completeness(column: str, at_least: float) -> Check:
    """The share of rows with a value; '' counts as none."""
    filled = F.count(F.nullif(F.col(column).cast("string"), F.lit("")))
    return Check(
        "completeness",
        f"{column} is filled",
        filled,
        filled >= F.count("*") * F.lit(at_least),
        f">= {at_least} of rows",
        at_least,
    )


def uniqueness(column: str) -> Check:
    distinct = F.count_distinct(F.col(column))
    return Check(
        "uniqueness", f"{column} is unique", distinct, distinct == F.count("*"), "one per row"
    )


def value_range(column: str, violates: Column, description: str) -> Check:
    broken = F.count_if(violates)
    return Check("range", description, broken, broken == 0, "0")


def freshness(column: str, now: datetime, minutes: int) -> Check:
    newest = F.max(F.col(column))
    limit = F.lit(now).cast("timestamp") - F.expr(f"INTERVAL {int(minutes)} MINUTES")
    return Check(
        "freshness",
        f"{column} is recent",
        newest,
        F.coalesce(newest.cast("timestamp") > limit, F.lit(False)),
        f"within {minutes} minutes",
        float(minutes),
    )


def run_checks(
    df: DataFrame, table_name: str, checks: list[Check], run_id: str, checked_at: datetime
) -> DataFrame:
    """All checks of a table in a single pass over it, one row per check."""
    measured = df.agg(
        *[
            F.struct(
                check.actual.cast("string").alias("actual"), check.passed.alias("passed")
            ).alias(f"_{i}")
            for i, check in enumerate(checks)
        ]
    )
    rows = [
        _result_row(
            i, table_name, check.check_type, check.description, check.expected,
            F.col(f"_{i}.actual"), F.col(f"_{i}.passed"), check.threshold, check.severity,
            run_id, checked_at,
        )
        for i, check in enumerate(checks)
    ]
    return measured.select(F.inline(F.array(*rows)))


def _result_row(
    number, table_name, check_type, description, expected, actual, passed, threshold,
    severity, run_id, checked_at,
) -> Column:
    values = {
        "check_id": F.lit(f"{table_name}.{check_type}.{number}"),
        "run_id": F.lit(run_id),
        "table_name": F.lit(table_name),
        "check_type": F.lit(check_type),
        "check_description": F.lit(description),
        "check_result": F.when(passed, F.lit("pass")).otherwise(F.lit(severity)),
        "expected_value": F.lit(expected),
        "actual_value": actual,
        "threshold": F.lit(threshold).cast("double"),
        "checked_at": F.lit(checked_at).cast("timestamp"),
    }
    return F.struct(*[values[name].alias(name) for name in RESULT_COLUMNS])


def orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Child keys without a parent, with their number of rows.

    Keys are counted first: the anti join then sees each key once, however many
    rows it has.
    """
    used = (
        child.where(F.col(child_key).isNotNull())
        .groupBy(F.col(child_key).alias("orphan_key"))
        .agg(F.count("*").alias("child_rows"))
    )
    return used.join(parent.select(F.col(parent_key).alias("orphan_key")), "orphan_key", "left_anti")


def referential_check(
    child: DataFrame, parent: DataFrame, child_key: str, parent_key: str,
    table_name: str, run_id: str, checked_at: datetime,
) -> DataFrame:
    missing = orphans(child, parent, child_key, parent_key)
    total = missing.agg(F.coalesce(F.sum("child_rows"), F.lit(0)).alias("n"))
    row = _result_row(
        0, table_name, "referential", f"{child_key} has a parent", "0",
        F.col("n").cast("string"), F.col("n") == 0, None, "fail", run_id, checked_at,
    )
    return total.select(F.inline(F.array(row)))


def volume_changes(runs: DataFrame, tolerance: float = 0.2) -> DataFrame:
    """Each run's row count against the run before it of the same topic and layer."""
    from quarrylake.operators.timeline import value_before

    # a struct, so that a run without a count still is the previous run
    previous = value_before(
        runs, ["topic_name", "layer"], "start_time", F.struct("records_written"), "_previous",
        then_by=[F.col("run_id")],
    )
    before = F.col("_previous.records_written")
    change = F.abs(F.col("records_written") - before)
    return previous.select(
        "run_id",
        "topic_name",
        "layer",
        "start_time",
        "records_written",
        before.alias("previous_records"),
        F.when(before.isNull(), "first")
        .when(change <= before * F.lit(tolerance), "pass")
        .otherwise("warn")
        .alias("check_result"),
    )


def volume_results(
    runs: DataFrame, run_id: str, checked_at: datetime, tolerance: float = 0.2
) -> DataFrame:
    """``volume_changes`` as rows of the common result table, one per run that has a run before it."""
    found = volume_changes(runs, tolerance).where(F.col("check_result") != "first")
    name = F.concat_ws(".", "layer", "topic_name")
    values = {
        "check_id": F.concat(name, F.lit(".volume."), F.col("run_id")),
        "run_id": F.lit(run_id),
        "table_name": name,
        "check_type": F.lit("volume"),
        "check_description": F.lit("rows written against the run before"),
        "check_result": F.col("check_result"),
        "expected_value": F.col("previous_records").cast("string"),
        "actual_value": F.col("records_written").cast("string"),
        "threshold": F.lit(tolerance),
        "checked_at": F.lit(checked_at).cast("timestamp"),
    }
    return found.select(*[values[column].alias(column) for column in RESULT_COLUMNS])


def error_histogram(df: DataFrame) -> DataFrame:
    return df.groupBy("_validation_errors").agg(F.count("*").alias("records"))


def errors_by_field(df: DataFrame) -> DataFrame:
    """How often each single error code occurs."""
    codes = F.explode(F.split("_validation_errors", ",")).alias("error")
    flagged = df.where(F.length("_validation_errors") > 0)
    return flagged.select(codes).groupBy("error").agg(F.count("*").alias("records"))


def invalid_share(df: DataFrame, limit: float = 0.05) -> DataFrame:
    """One row: valid and invalid counts, the invalid share, and the alert flag."""
    invalid = F.count_if(F.col("_record_status") == INVALID)
    share = F.try_divide(invalid.cast("double"), F.count("*"))
    return df.agg(
        F.count("*").alias("records"),
        invalid.alias("invalid_records"),
        share.alias("invalid_share"),
        F.coalesce(share > F.lit(limit), F.lit(False)).alias("alert"),
    )


def date_gaps(df: DataFrame, column: str, start: str | None = None, end: str | None = None) -> DataFrame:
    """Calendar days without a row, between the given or the observed limits."""
    days = df.select(F.to_date(column).alias("missing_date")).distinct()
    first = F.lit(start).cast("date") if start else F.min("missing_date")
    last = F.lit(end).cast("date") if end else F.max("missing_date")
    axis = days.agg(first.alias("first"), last.alias("last")).select(
        F.explode(F.sequence("first", "last")).alias("missing_date")
    )
    return axis.join(days, "missing_date", "left_anti")


def unknown_json_keys(lines: DataFrame, text: str, known: list[str]) -> DataFrame:
    """Top-level keys in raw JSON text that the schema does not name, with counts."""
    keys = lines.select(F.explode(F.json_object_keys(text)).alias("json_key"))
    counted = keys.groupBy("json_key").agg(F.count("*").alias("records"))
    return counted.where(~F.col("json_key").isin(known)) if known else counted


_NUMBERS = "BIGINT|DECIMAL.*|DOUBLE|FLOAT"
_KINDS = {
    "string": "STRING", "boolean": "BOOLEAN", "double": _NUMBERS, "float": _NUMBERS,
    "int": r"BIGINT|DECIMAL\(\d+,0\)", "bigint": r"BIGINT|DECIMAL\(\d+,0\)",
}


def _declared_paths(kind, path: str = "") -> dict[str, str]:
    """Path -> the kinds of JSON value that fit there, as a pattern."""
    if isinstance(kind, StructType):
        found = {path: "OBJECT.*"} if path else {}
        for part in kind.fields:
            found |= _declared_paths(part.dataType, f"{path}.{part.name}".lstrip("."))
        return found
    if isinstance(kind, ArrayType):
        return {path: "ARRAY.*"} | _declared_paths(kind.elementType, f"{path}[]")
    return {path: _KINDS.get(kind.simpleString(), "STRING")}


def json_drift(lines: DataFrame, text: str, schema: StructType) -> DataFrame:
    """(path, finding, found_type, records): how raw JSON departs from the declared schema.

    * ``new``: a path that is not declared, with the type that all its values have in common;
    * ``retyped``: values of a declared path that are of another type, and what they have in common;
    * ``missing``: values of the parent that lack the declared path.

    ``items[]`` is an element of ``items``. Paths are followed one level deeper than the schema, so
    parts of new objects are named too. JSON's null fits everywhere. Lines that are no JSON object are
    left out. Lines are read and parsed once and exploded where they lie, level by level; only counts per
    path are shuffled.
    """
    declared = _declared_paths(schema)
    # a filter does not pass below a column that is exploded, so it does not parse the line again
    parsed = lines.select(F.explode(F.array(F.try_parse_json(F.col(text)))).alias("_value0"))
    rows = parsed.where(F.schema_of_variant("_value0").startswith("OBJECT")).select(F.lit("").alias("_path0"), "_value0")
    depth = 1 + max(f"{path}.".replace("[]", ".").count(".") for path in declared)
    explode = lines.sparkSession.tvf.variant_explode_outer
    for level in range(1, depth + 1):
        above = f"_path{level - 1}"
        parts = rows.lateralJoin(explode(F.col(f"_value{level - 1}").outer()))
        step = F.when(F.col("key").isNull(), F.lit("[]"))
        step = step.when(F.col(above) == "", F.col("key")).otherwise(F.concat(F.lit("."), "key"))
        first = F.coalesce(F.col("pos"), F.lit(0)) == 0  # a value stays with its first part only, so it counts once
        rows = parts.select(
            *[F.col(f"_path{n}") for n in range(level)],
            *[F.when(first, F.col(f"_value{n}")).alias(f"_value{n}") for n in range(level)],
            F.concat(above, step).alias(f"_path{level}"), F.col("value").alias(f"_value{level}"),
        )
    levels = [F.struct(F.col(f"_path{n}").alias("path"), F.col(f"_value{n}").alias("_value")) for n in range(depth + 1)]
    seen = rows.select(F.explode(F.array(*levels)).alias("_seen")).select("_seen.*").where("_value IS NOT NULL")

    expected = F.create_map(*[F.lit(part) for pair in declared.items() for part in pair])[F.col("path")]
    kind = F.schema_of_variant("_value")
    known = F.when(F.col("path") == "", F.lit("OBJECT.*")).otherwise(expected)
    unfit = (kind != "VOID") & ~F.regexp_like(kind, F.concat(F.lit("^("), known, F.lit(")$")))
    counted = seen.groupBy("path", known.alias("_known")).agg(
        F.count("*").alias("_values"),
        F.count_if(kind.startswith("OBJECT")).alias("_objects"),
        F.schema_of_variant_agg("_value").alias("_type"),
        F.count_if(unfit).alias("_unfit"),
        F.schema_of_variant_agg(F.when(unfit, F.col("_value"))).alias("_unfit_type"),
    )

    def found(path: Column, finding: str, kind: Column, records: Column) -> Column:
        return F.struct(path.alias("path"), F.lit(finding).alias("finding"), kind.alias("found_type"), records.alias("records"))

    path, none = F.col("path"), F.lit(None).cast("string")
    named = [name for name in declared if not name.endswith("[]")]
    findings = [
        F.when(F.col("_known").isNull(), found(path, "new", F.col("_type"), F.col("_values"))),
        F.when(F.col("_unfit") > 0, found(path, "retyped", F.col("_unfit_type"), F.col("_unfit"))),
        # missing: the parent's objects less the path's own values
        F.when(path.isin(named), found(path, "missing", none, -F.col("_values"))),
        *[F.when(path == name.rpartition(".")[0], found(F.lit(name), "missing", none, F.col("_objects"))) for name in named],
    ]
    each = counted.select(F.explode(F.array(*findings)).alias("_found")).where("_found IS NOT NULL").select("_found.*")
    summed = each.groupBy("path", "finding").agg(F.max("found_type").alias("found_type"), F.sum("records").alias("records"))
    return summed.where("records > 0")


def freshness_sla(
    df: DataFrame, column: str, table_name: str, minutes: int, now: datetime
) -> DataFrame:
    """One row: whole minutes since the newest row and whether the limit is met."""
    moment = F.lit(now).cast("timestamp")
    latency = F.timestamp_diff("MINUTE", F.max(F.col(column)).cast("timestamp"), moment)
    return df.agg(latency.cast("double").alias("latency")).select(
        F.lit(table_name).alias("table_name"),
        F.lit("freshness").alias("sla_type"),
        F.lit(minutes).alias("sla_threshold_minutes"),
        F.col("latency").alias("actual_latency_minutes"),
        F.coalesce(F.col("latency") <= minutes, F.lit(False)).alias("sla_met"),
        moment.alias("checked_at"),
    )
