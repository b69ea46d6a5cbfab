"""Clean-up of a training corpus: the text operators as stages over ``documents``.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read again as
the next one's docs. All but the last one return the columns of ``documents``:

* toxicity: documents that the network, fitted to ``labels``, scores at 0.5 or more go;
* line dedup: lines that an earlier line matches go, and documents that consist of such lines;
* near dedup: one document of each class of near-duplicates stays;
* decontamination: documents that contain a ``benchmark`` item go;
* packing: the pieces of the documents in training windows, with their token ids.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quarrylake.llm import decontam, linededup, neardup, packing, toxicity
from quarrylake.llm.common import table, written
from quarrylake.llm.queries import TOKENIZER, tokenizer_file


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.accepted(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return linededup.clean(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return neardup.one_of_each(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.clean(docs, table(spark, sf_dir, "benchmark"))


def pack_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, tokenizer_file(TOKENIZER))


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_repeated_lines),
    ("near dedup", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("packing", pack_documents),
]

#: A trained network, samples and a tokenizer have no counterpart in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
