"""Every registered query against its SQL, on the smallest tables."""

import re
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as entry
from tests.oracle import TESTDATA, connect, difference

FOLDER = f"{TESTDATA}/sf0.001"


@pytest.fixture(scope="module")
def sql():
    return connect(FOLDER)


#: The text queries have tests of their own, some of them without SQL.
NAMES = [name for name in entry.oracle_sql() if not re.match(r"op\d+_|pipeline$", name)]


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_sql(spark, sql, name):
    df = entry.queries()[name](spark, FOLDER)
    assert difference(df, sql, entry.oracle_sql()[name]) is None


def test_entry(spark):
    assert entry.entry(spark).count() > 0
