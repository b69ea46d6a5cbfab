"""Row-level checks: every broken rule adds its code to the row's error list."""

from __future__ import annotations

from datetime import datetime, timezone
from functools import reduce
from operator import or_
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarrylake.functions.columns import is_blank

VALID, INVALID = "valid", "invalid"

# A plain shape test, not the full address grammar.
EMAIL_PATTERN = r"^[^@\s]+@[^@\s]+\.[^@\s]+$"


class Rule(NamedTuple):
    code: str
    broken: Column


def required_rules(df: DataFrame, fields) -> list[Rule]:
    """One rule per field. A field the frame does not have is broken in every row."""
    present = set(df.columns)
    return [
        Rule(f"missing_{name}", is_blank(F.col(name)) if name in present else F.lit(True))
        for name in fields
    ]


def type_rules(types: dict[str, str]) -> list[Rule]:
    """Broken where a value is given but cannot be read as the declared type."""
    return [
        Rule(
            f"bad_type_{name}",
            ~is_blank(F.col(name)) & F.col(name).try_cast(kind).isNull(),
        )
        for name, kind in types.items()
    ]


def range_rule(name: str, low=None, high=None, *, low_open: bool = False) -> Rule:
    """Broken where a value lies outside the given limits; NULL is not judged."""
    value, tests = F.col(name), []
    if low is not None:
        tests.append(value <= low if low_open else value < low)
    if high is not None:
        tests.append(value > high)
    if not tests:
        raise ValueError(f"no limit for {name}")
    broken = tests[0] if len(tests) == 1 else tests[0] | tests[1]
    return Rule(f"out_of_range_{name}", F.coalesce(broken, F.lit(False)))


def future_rule(name: str, now: datetime) -> Rule:
    moment = F.col(name).try_cast("timestamp")
    return Rule(f"future_{name}", F.coalesce(moment > F.lit(now), F.lit(False)))


def format_rule(name: str, pattern: str) -> Rule:
    return Rule(f"bad_format_{name}", ~is_blank(F.col(name)) & ~F.col(name).rlike(pattern))


def apply_rules(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """Add ``_validation_errors`` (codes in rule order) and ``_record_status``.

    Without any rule the error text is NULL; with rules a clean row has ''.
    """
    codes = [F.when(rule.broken, F.lit(rule.code)) for rule in rules]
    # concat_ws leaves NULL entries out
    errors = F.concat_ws(",", *codes) if codes else F.lit(None).cast("string")
    # from the conditions, not from the text: a status filter then reaches the scan
    any_broken = reduce(or_, [rule.broken for rule in rules], F.lit(False))
    return df.withColumns(
        {
            "_validation_errors": errors,
            "_record_status": F.when(any_broken, INVALID).otherwise(VALID),
        }
    )


def validate_required_fields(df: DataFrame, required_fields) -> DataFrame:
    return apply_rules(df, required_rules(df, required_fields))


def add_audit_columns(df: DataFrame, ingested_at: datetime | None = None) -> DataFrame:
    """Stamp the rows with one fixed time and with the file they came from.

    The time is a literal: it is the same in every action on the batch. A stream
    must select ``_metadata.file_path`` as ``_source_file`` before it is started;
    such a column is kept.
    """
    moment = ingested_at or datetime.now(timezone.utc)
    df = df.withColumn("_ingestion_timestamp", F.lit(moment).cast("timestamp"))
    if "_source_file" not in df.columns:
        df = df.withColumn("_source_file", F.input_file_name())
    return df


def split_by_status(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Valid rows and quarantined rows; together they are the input."""
    status = F.col("_record_status")
    return df.where(status == VALID), df.where(status == INVALID)
