"""The registered queries over the given tables, each with its SQL counterpart."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

SHIFT = 0.0000013

QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None, rounded: tuple[str, ...] = ()):
    """Register ``fn(inputs) -> DataFrame`` under its own name, with its SQL if it has one.

    The result's ``rounded`` columns, sums and means of doubles, are rounded to four
    decimals on both sides: their last bits depend on the order of the rows. They are
    shifted a little first, as means of amounts often lie exactly between two roundings.
    """
    from quarrylake.queries.inputs import Inputs

    def register(fn):
        key = name or fn.__name__

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            # text timestamps end in Z, and the SQL side has no time zones
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            df = fn(Inputs(spark, sf_dir))
            return df.withColumns({c: F.round(F.col(c) + SHIFT, 4) for c in rounded}) if rounded else df

        run.__name__, run.__doc__ = key, fn.__doc__
        QUERIES[key] = run
        if sql:
            ORACLE_SQL[key] = sql.strip()
            if rounded:
                parts = ", ".join(f"round({c} + {SHIFT:.7f}, 4) AS {c}" for c in rounded)
                ORACLE_SQL[key] = f"SELECT * REPLACE ({parts}) FROM ({sql.strip()})"
        return fn

    return register


def load_all() -> None:
    for part in ("layers", "quality", "changes", "reports", "storage"):
        import_module(f"quarrylake.queries.{part}")
