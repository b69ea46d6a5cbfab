"""Exact top-k search by inner product over integer vectors, by MaxScore.

A term is a dimension; its posting list is the column of all vectors of a shard. With the
least and greatest value of each column, a query knows how much each term adds at least
and at most. Its terms, by falling spread, are split: the non-essential ones are those that
cannot lift a vector to the query's k-th best score so far unless an essential term lifts it
off its minimum. The essential postings are traversed for the whole shard; the others are probed a
few at a time, and only for vectors that can still compete. Every shard gives its k best,
and the shards are merged.

Queries come in blocks and vectors in shards of bounded size; each task searches one
shard for one block.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SHARD_ROWS = 4096
BLOCK_ROWS = 4096
#: Vectors that are scored in full to get a first threshold, and terms probed at a time.
SEED_ROWS, PROBE_TERMS = 256, 8


def integer_vectors(df: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", scale: int = 64) -> DataFrame:
    """(vec_id, values): floor(scale * x) of each component, x as double.

    Rows whose id is null, whose vector is null, or whose vector holds a null, NaN or
    infinity take no part. Rows that repeat id and vector count once. Other columns are dropped.
    """
    x = F.col("raw")
    sound = ~F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return (
        df.select(df[id_column].alias("vec_id"), df[vector_column].cast("array<double>").alias("raw"))
        .where(F.col("vec_id").isNotNull() & x.isNotNull() & sound)
        .select("vec_id", F.transform(x, lambda v: F.floor(v * scale).cast("long")).alias("values"))
        .distinct()
    )


def _matrix(rows, width: int, kind) -> np.ndarray:
    out = np.zeros((len(rows), width), kind)
    for at, row in enumerate(rows):
        out[at, : len(row)] = row
    return out


def _best(score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    return np.lexsort((ids, -score))[:k]


def search(ids: np.ndarray, vectors: np.ndarray, query_ids, queries: np.ndarray, k: int):
    """For each query its k best vectors of a shard: positions and scores."""
    columns = np.ascontiguousarray(vectors.T)
    least, most = vectors.min(axis=0), vectors.max(axis=0)
    for query_id, query in zip(query_ids, queries):
        low, high = np.minimum(query * least, query * most), np.maximum(query * least, query * most)
        terms = np.argsort(low - high, kind="stable")
        lows = np.concatenate([[0], np.cumsum(low[terms])])
        highs = np.concatenate([np.cumsum(high[terms][::-1])[::-1], [0]])
        seed = np.flatnonzero(ids[:SEED_ROWS] != query_id)
        threshold = None
        if len(seed) >= k:
            first = query @ columns[:, :SEED_ROWS]
            threshold = np.partition(first[seed], len(seed) - k)[len(seed) - k]
        split = len(terms)
        if threshold is not None:
            below = np.flatnonzero(lows + highs < threshold)
            split = below[0] if len(below) else split
        essential = terms[:split]
        score = query[essential] @ columns[essential]
        alive = np.flatnonzero(ids != query_id)
        score = score[alive]
        for at in range(split, len(terms) + PROBE_TERMS, PROBE_TERMS):
            at = min(at, len(terms))
            if len(score) > k:
                # k vectors reach at least this, whatever the other terms add
                sure = np.partition(score, len(score) - k)[len(score) - k] + (lows[-1] - lows[at])
                threshold = sure if threshold is None else max(threshold, sure)
            if threshold is not None:
                keep = score + highs[at] >= threshold
                alive, score = alive[keep], score[keep]
            if at == len(terms):
                break
            probed = terms[at : at + PROBE_TERMS]
            score = score + query[probed] @ columns[np.ix_(probed, alive)]
        best = _best(score, ids[alive], k)
        yield query_id, alive[best], score[best]


def top_k(queries: DataFrame, vectors: DataFrame, k: int = 20, shard_rows: int = SHARD_ROWS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score): the k vectors of highest inner product with each query.

    Both inputs are (vec_id, values array of long). A vector with the query's own id is
    no candidate; ties go to the smaller id; fewer than k candidates give all. Vectors of
    unequal length count as filled up with zeros. A score beyond 53 bits is an error. No
    queries or no vectors give no rows.
    """
    shards = -(-vectors.count() // shard_rows) or 1
    blocks = -(-queries.count() // block_rows) or 1
    kind = queries.schema["vec_id"].dataType.simpleString()
    place = lambda n: F.pmod(F.xxhash64("vec_id"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    asked = queries.select("vec_id", "values", place(blocks).alias("block"), every(shards).alias("shard"))
    held = vectors.select("vec_id", "values", place(shards).alias("shard"), every(blocks).alias("block"))

    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        names = ["query_id", "vec_id", "score"]
        if left.empty or right.empty:
            return pd.DataFrame({n: [] for n in names})
        width = max(max(map(len, left["values"])), max(map(len, right["values"])))
        peak = [max((abs(int(f(v))) for v in side["values"] if len(v) for f in (np.min, np.max)), default=0) for side in (left, right)]
        bound = peak[0] * peak[1] * max(width, 1)
        if bound >= 2**53:
            raise ValueError("components are too large: a score could leave 53 bits")
        exact = np.float32 if bound < 2**24 else np.float64
        right = right.sort_values("vec_id")
        ids = right["vec_id"].to_numpy()
        found = list(search(ids, _matrix(right["values"], width, exact), left["vec_id"].to_numpy(), _matrix(left["values"], width, exact), k))
        return pd.DataFrame(
            {
                "query_id": np.repeat([f[0] for f in found], [len(f[1]) for f in found]),
                "vec_id": ids[np.concatenate([f[1] for f in found])],
                "score": np.concatenate([f[2] for f in found]).astype(np.int64),
            }
        )

    found = (
        asked.groupBy("block", "shard")
        .cogroup(held.groupBy("block", "shard"))
        .applyInPandas(run, f"query_id {kind}, vec_id {kind}, score long")
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
