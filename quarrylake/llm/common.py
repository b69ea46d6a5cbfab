"""Small helpers that several of the text operators share."""

from __future__ import annotations

import os
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from quarrylake.workspace import new_folder

#: Rows in one Arrow batch: a worker holds the texts of one batch at a time.
BATCH_ROWS = 512


def findable(spark: SparkSession) -> None:
    """Let Python workers look for this package where the driver found it."""
    root = str(Path(__file__).resolve().parents[2])
    environment = spark.sparkContext.environment
    paths = [p for p in environment.get("PYTHONPATH", os.environ.get("PYTHONPATH", "")).split(os.pathsep) if p]
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([root, *paths])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    findable(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def fold(column: str, folds: int) -> Column:
    """Fold of a row by the CRC of its id as text; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % folds


def written(df: DataFrame, purpose: str, partition_by: str | None = None) -> DataFrame:
    """The rows as a table in the shared folder: cuts lineage, survives lost executors."""
    spark, folder = df.sparkSession, new_folder(df.sparkSession, purpose)
    writer = df.write.partitionBy(partition_by) if partition_by else df.write
    writer.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


def arrow_type(df: DataFrame, column: str) -> pa.DataType:
    return to_arrow_type(df.schema[column].dataType)


def arrow_map(df: DataFrame, function, schema: str) -> DataFrame:
    """``function(batches of dict column -> list) -> rows as dict of lists``, run per partition."""
    findable(df.sparkSession)
    names_types = _arrow_schema(df.sparkSession, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for out in function(b for b in batches if b.num_rows):
            yield pa.RecordBatch.from_arrays(
                [
                    out[f.name].cast(f.type) if isinstance(out[f.name], pa.Array) else pa.array(out[f.name], f.type)
                    for f in names_types
                ],
                schema=names_types,
            )

    return df.mapInArrow(run, schema)


def arrow_filter(df: DataFrame, text_column: str, keeper) -> DataFrame:
    """Rows of ``df``, all columns as they are, where ``keeper()(texts) -> list of bool`` holds.

    ``keeper`` is called once per partition.
    """
    findable(df.sparkSession)
    place = df.columns.index(text_column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep = keeper()
        for batch in batches:
            if batch.num_rows:
                yield batch.filter(pa.array(keep(batch.column(place).to_pylist()), pa.bool_()))

    return df.mapInArrow(run, df.schema)


def _arrow_schema(spark: SparkSession, schema: str) -> pa.Schema:
    from pyspark.sql.types import StructType

    return pa.schema([(f.name, to_arrow_type(f.dataType)) for f in StructType.fromDDL(schema)])


def connected(links: DataFrame, purpose: str) -> DataFrame:
    """(node, root) for every node of the links (a, b): root is the least node of its component.

    Each round every node takes the least label among itself and its neighbours, then
    the label of its label (pointer jumping), so the rounds grow with the logarithm of
    the longest chain. Minima are combined before the shuffle, so a node with many
    links costs no more than others. Every round is written to the shared folder.
    """
    pairs = links.where("a IS NOT NULL AND b IS NOT NULL AND a <> b")
    edges = written(pairs.select("a", "b").unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), purpose)
    labels = written(edges.groupBy(F.col("a").alias("node")).agg(F.least(F.col("node"), F.min("b")).alias("root")), purpose)
    while True:
        near = (
            edges.join(labels.select(F.col("node").alias("b"), "root"), "b")
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("root").alias("seen"))
        )
        step = labels.join(near, "node").select("node", "root", F.least("root", "seen").alias("low"))
        jump = labels.select(F.col("node").alias("low"), F.col("root").alias("lower"))
        step = step.join(jump, "low").select("node", F.least("low", "lower").alias("root"), (F.col("root") != F.least("low", "lower")).alias("moved"))
        step = written(step, purpose)
        if step.where("moved").isEmpty():
            return step.select("node", "root")
        labels = step.select("node", "root")


# --- words and shingles of texts as 64-bit numbers, in numpy ---

_LETTER = np.zeros(256, bool)
for _code in range(256):
    _LETTER[_code] = _code >= 128 or chr(_code).isalnum()
_BYTE = np.random.default_rng(11).integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_BYTE[65:91] = _BYTE[97:123]  # capital A-Z counts as small
_ODD, _ODD_INVERSE = 0x9E3779B97F4A7C15, pow(0x9E3779B97F4A7C15, -1, 2**64)
_powers: list[np.ndarray] = []


def _power_tables(length: int) -> list[np.ndarray]:
    if not _powers or len(_powers[0]) < length:
        size = max(length, 1 << 18)
        _powers[:] = []
        for base in (_ODD, _ODD_INVERSE):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers.append(np.multiply.accumulate(steps))
    return _powers


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def words_of(text: str | bytes | None, longest: int | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each word: its number, and where it starts and ends in the text's UTF-8 bytes.

    A word is a run of ASCII letters, digits and any characters beyond ASCII; A-Z counts
    as a-z. Null is the empty text. With ``longest``, longer words are cut after so many bytes.
    """
    raw = text if isinstance(text, bytes) else (text or "").encode("utf-8", "replace")
    raw = np.frombuffer(raw, np.uint8)
    if not len(raw):
        return np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64)
    inside = np.empty(len(raw) + 2, np.int8)
    inside[0] = inside[-1] = 0
    inside[1:-1] = _LETTER[raw]
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[::2], edges[1::2]
    if longest and len(starts) and (ends - starts).max() > longest:
        pieces = -(-(ends - starts) // longest)
        within = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        stop = np.repeat(ends, pieces)
        starts = np.repeat(starts, pieces) + within * longest
        ends = np.minimum(starts + longest, stop)
    power, inverse = _power_tables(len(raw))
    sums = np.empty(len(raw) + 1, np.uint64)
    sums[0] = 0
    np.cumsum(_BYTE[raw] * power[: len(raw)], out=sums[1:])
    return mixed((sums[ends] - sums[starts]) * inverse[starts]), starts, ends


_PLACE = np.random.default_rng(12).integers(1, 2**63, 64, dtype=np.uint64) | np.uint64(1)


def shingles_of(words: np.ndarray, size: int) -> np.ndarray:
    """The number of each run of ``size`` words, in order; a shorter text is one run of all its words."""
    if not len(words):
        return np.empty(0, np.uint64)
    if len(words) < size:
        return mixed(np.array([(words * _PLACE[: len(words)]).sum(dtype=np.uint64) + np.uint64(len(words))], np.uint64))
    count = len(words) - size + 1
    total = np.zeros(count, np.uint64)
    for place in range(size):
        total += words[place : place + count] * _PLACE[place]
    return mixed(total)


def joined(texts: list[str | None], size: int = 1 << 20):
    """Neighbouring texts as one byte string of about ``size`` or less: (bytes, where each starts).

    A text that is longer stands alone. Texts are parted by a line feed, and the places
    end with the length plus one.
    """
    held, places, length = [], [0], 0
    for text in texts:
        coded = (text or "").encode("utf-8", "replace")
        if held and length + len(coded) > size:
            yield b"\n".join(held), np.array(places)
            held, places, length = [], [0], 0
        held.append(coded)
        length += len(coded) + 1
        places.append(length)
    if held:
        yield b"\n".join(held), np.array(places)
