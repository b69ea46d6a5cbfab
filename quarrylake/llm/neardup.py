"""Near-duplicate documents by improved consistent weighted sampling.

A document is the weighted set of its five-word shingles: occurrences times a damped
inverse document frequency. Document frequencies are counted for hash buckets of the
shingles, over all documents, so the table has a fixed size. Consistent weighted samples
agree with the probability of the weighted Jaccard similarity; groups of samples make bands,
and documents that share a band are candidates.

Every candidate pair is verified on the texts (see ``bandjoin``). Exact copies are merged
before all this.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarrylake.llm.bandjoin import components
from quarrylake.llm.common import arrow_map, mixed, shingles_of, text_or_empty, words_of, written

SHINGLE, THRESHOLD = 5, 0.8
#: At 0.8 a pair shares no band with probability (1 - 0.8^3)^13 = 0.0001.
BANDS, ROWS = 13, 3
FREQUENCY_BITS = 18
DAMPING = 0.2
_SEEDS = np.random.default_rng(21).integers(1, 2**63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_CELLS = 1 << 16


def _gamma_table(seed: int) -> np.ndarray:
    """Values of a gamma distribution of shape 2: the sum of two exponential ones."""
    return np.random.default_rng(seed).gamma(2.0, 1.0, _CELLS).astype(np.float32)


_R, _LOG_C = _gamma_table(31), np.log(_gamma_table(32))


def shingles(text: str | None) -> np.ndarray:
    return shingles_of(words_of(text)[0], SHINGLE)


def bucket(found: np.ndarray) -> np.ndarray:
    return (found >> np.uint64(64 - FREQUENCY_BITS)).astype(np.int64)


def weighted_set(text: str | None, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Different shingles of the text, ascending, and their weights."""
    keys, counts = np.unique(shingles(text), return_counts=True)
    return keys, (counts * idf[bucket(keys)]).astype(np.float32)


def weighted_jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    if not len(a[0]) or not len(b[0]):
        return 0.0
    _, at_a, at_b = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    least = np.minimum(a[1][at_a], b[1][at_b]).sum(dtype=np.float64)
    return float(least / (a[1].sum(dtype=np.float64) + b[1].sum(dtype=np.float64) - least))


def samples(keys: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """One number per sample: the chosen shingle with its quantised log weight."""
    log_w = np.log(weights)[:, None]
    best = np.full(len(_SEEDS), np.inf, np.float32)
    out = np.zeros(len(_SEEDS), np.uint64)
    for at in range(0, len(keys), 4096):
        u = keys[at : at + 4096, None] * _SEEDS
        u ^= u >> np.uint64(32)
        r = _R[(u >> np.uint64(48)).astype(np.int64)]
        beta = ((u >> np.uint64(32)) & np.uint64(_CELLS - 1)).astype(np.float32) / np.float32(_CELLS)
        t = np.floor(log_w[at : at + 4096] / r + beta)
        log_a = _LOG_C[((u >> np.uint64(16)) & np.uint64(_CELLS - 1)).astype(np.int64)] - r * (t - beta + 1)
        low = log_a.argmin(axis=0)
        column = np.arange(len(_SEEDS))
        better = log_a[low, column] < best
        best = np.where(better, log_a[low, column], best)
        number = keys[at + low] + t[low, column].astype(np.int64).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        out = np.where(better, mixed(number), out)
    return out


def bands(keys: np.ndarray, weights: np.ndarray) -> np.ndarray:
    chosen = samples(keys, weights).reshape(BANDS, ROWS)
    total = np.arange(BANDS, dtype=np.uint64)
    for row in range(ROWS):
        total = mixed(total * np.uint64(0xBF58476D1CE4E5B9) + chosen[:, row])
    return total.view(np.int64)


def inverse_frequencies(docs: DataFrame) -> np.ndarray:
    """Damped inverse document frequency per bucket: 1 - DAMPING * log(1 + n) / log(1 + documents).

    ``n`` is the number of documents with a shingle of the bucket. The plain logarithm would weigh down the
    shingles of a text that is copied over a large share of the corpus, and hide its near copies.
    """

    def run(batches):
        total, count = np.zeros(1 << FREQUENCY_BITS, np.int64), 0
        for batch in batches:
            for text in batch.column(0):
                total[np.unique(bucket(shingles(text.as_py())))] += 1
                count += 1
        if count:
            keys = np.flatnonzero(total)
            yield {"bucket": np.append(keys, -1), "n": np.append(total[keys], count)}

    counted = arrow_map(docs.select("text"), run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    found = counted.toArrow()  # as many rows as buckets at most, without an object for each
    out = np.zeros(1 << FREQUENCY_BITS)
    if found.num_rows:
        buckets, n = (found.column(c).to_numpy() for c in ("bucket", "n"))
        out[buckets[buckets >= 0]] = n[buckets >= 0]
        out = np.log1p(out) / np.log1p(n[buckets < 0][0])
    return (1 - DAMPING * out).astype(np.float32)


def classes(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(the id, content, class_id, copies) per row: rows with one class_id are near-duplicates of each other.

    ``class_id`` is the least id of the class, ``copies`` the number of rows with exactly
    this text, ``content`` the text's digest. Documents are linked if the weighted
    Jaccard similarity of their shingles is at least 0.8; links are transitive. A text without any
    word (null, empty, signs only) is in a class with its exact copies. A text of fewer
    than five words is one shingle. Rows that repeat an id count as rows of their own;
    other columns are not read. A null id is less than any other.
    """
    rows = docs.select(docs[id_column].alias("doc_id"), text_or_empty(text_column).alias("text"))
    rows = rows.withColumn("content", F.md5(F.col("text").cast("binary")))
    idf = docs.sparkSession.sparkContext.broadcast(inverse_frequencies(rows))  # 2^FREQUENCY_BITS numbers
    kind = rows.schema["doc_id"].dataType.simpleString()

    def sign(batches):
        for batch in batches:
            found = [weighted_set(text.as_py(), idf.value) for text in batch.column(1)]
            yield {
                "doc_id": batch.column(0),
                "content": batch.column(2),
                "bands": [bands(*f).tolist() if len(f[0]) else [] for f in found],
            }

    signed = written(arrow_map(rows, sign, f"doc_id {kind}, content string, bands array<long>"), "signatures")
    contents = signed.groupBy("content").agg(
        F.min(F.struct("doc_id")).alias("first"), F.count("*").alias("copies"), F.first("bands").alias("bands")
    )

    def texts_of(wanted: DataFrame) -> DataFrame:
        """The text of each content, found by the first id that has it."""
        firsts = contents.join(wanted, "content", "left_semi").select("content", F.col("first.doc_id").alias("first_id"))
        found = rows.join(
            firsts, (rows["content"] == firsts["content"]) & rows["doc_id"].eqNullSafe(firsts["first_id"]), "left_semi"
        )
        return found.groupBy("content").agg(F.first("text").alias("text"))

    roots = components(
        contents, texts_of, lambda text: weighted_set(text, idf.value), weighted_jaccard, THRESHOLD, "near"
    )
    named = contents.join(roots, "content", "left").withColumn(
        "root", F.coalesce("root", "content")
    )
    least = named.groupBy("root").agg(F.min("first").alias("class"))
    known = named.select("content", "root", "copies").join(least, "root").select("content", "copies", F.col("class.doc_id").alias("class_id"))
    return signed.select("doc_id", "content").join(known, "content").select("doc_id", "content", "class_id", "copies")


def one_of_each(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row of each class of near-duplicates, with all its columns: the one of least id (see ``classes``)."""
    found = classes(docs, id_column, text_column)
    first = found.where(F.col("doc_id").eqNullSafe(F.col("class_id"))).groupBy("class_id").agg(F.min("content").alias("content"))
    named = docs.withColumn("content of row", F.md5(text_or_empty(text_column).cast("binary")))
    kept = named.join(
        first, (named["content of row"] == first["content"]) & named[id_column].eqNullSafe(first["class_id"]), "left_semi"
    )
    return kept.dropDuplicates([id_column, "content of row"]).select(*[docs[c] for c in docs.columns])
