"""The text queries and the pipeline over the smallest tables."""

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from quarrylake.llm.common import table, written
from tests.oracle import TESTDATA, connect, difference

FOLDER = f"{TESTDATA}/sf0.001"
SQL = {name: sql for name, sql in entry.oracle_sql().items() if name.startswith("op")}


@pytest.mark.parametrize("name", SQL)
def test_query_matches_sql(spark, name):
    assert difference(entry.queries()[name](spark, FOLDER), connect(FOLDER), SQL[name]) is None


def test_operators_and_the_pipeline_are_registered():
    numbers = sorted(int(n[2:].split("_")[0]) for n in entry.queries() if n.startswith("op") and n[2].isdigit())
    assert numbers == list(range(1, 14)) and "pipeline" in entry.queries()


def test_stages_keep_the_columns_and_take_effect(spark):
    docs = table(spark, FOLDER, "documents")
    ids = [{r.doc_id for r in docs.select("doc_id").collect()}]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = written(stage(spark, docs, FOLDER), "stage")
        assert after.dtypes == docs.dtypes
        ids.append({r.doc_id for r in after.select("doc_id").collect()})
        docs = after
    assert all(later <= earlier for earlier, later in zip(ids, ids[1:]))
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER)
    assert {r.doc_id for r in pieces.select("doc_id").distinct().collect()} == ids[-1]


def test_stages_on_an_empty_table(spark):
    docs = table(spark, FOLDER, "documents").where("false")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, FOLDER).count() == 0
