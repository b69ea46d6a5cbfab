"""Run registered queries next to their SQL and compare: python tests/oracle.py [sf] [names...]."""

from __future__ import annotations

import datetime
import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
TESTDATA = "/root/testdata"


def connect(folder: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else float(f"{value:.12g}")
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None)
    if isinstance(value, (list, tuple)):
        return tuple(_plain(v) for v in value)
    return value


def _canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(
        (tuple(_plain(row[i]) for i in order) for row in rows),
        key=lambda row: tuple((v is None, str(type(v)), str(v)) for v in row),
    )


SPARK_TO_SQL = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "timestamp": "TIMESTAMP",
    "timestamp_ntz": "TIMESTAMP",
}


def difference(df, con, sql: str) -> str | None:
    """None if both give the same columns, types and rows, else what differs."""
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    kinds = {d[0]: str(d[1]) for d in cursor.description}
    expected = cursor.fetchall()
    mine = {name: SPARK_TO_SQL.get(kind, kind) for name, kind in df.dtypes}
    if mine != kinds:
        return f"types {sorted(set(mine.items()) ^ set(kinds.items()))}"
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} vs {sorted(names)}"
    got = [tuple(row) for row in df.collect()]
    if len(got) != len(expected):
        return f"rows {len(got)} vs {len(expected)}"
    pairs = zip(_canonical(df.columns, got), _canonical(names, expected))
    for mine, theirs in pairs:
        if mine != theirs or [type(v) for v in mine] != [type(v) for v in theirs]:
            return f"{mine}\n  vs {theirs}"
    return None


def main():
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    folder = f"{TESTDATA}/sf{sf}"
    con = connect(folder)
    sqls, bad = entry.oracle_sql(), 0
    for name, run in entry.queries().items():
        if len(sys.argv) > 2 and name not in sys.argv[2:]:
            continue
        started = time.time()
        try:
            df = run(spark, folder)
            result = difference(df, con, sqls[name]) if name in sqls else f"no SQL, {df.count()} rows"
        except Exception as error:  # report and go on with the next query
            result = f"{type(error).__name__}: {str(error)[:600]}"
        bad += bool(result) and not result.startswith("no SQL")
        print(f"{name}: {result or 'ok'} ({time.time() - started:.1f} s)", flush=True)
    print("differences:", bad)


if __name__ == "__main__":
    main()
