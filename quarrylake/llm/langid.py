"""Language identification: sparse multinomial logistic regression on character n-grams.

Features are the hashed runs of one to three characters of the lower-cased text, weighed
by TF-IDF: relative frequency times the log inverse document frequency, counted over all
training documents. Weights come from follow-the-regularised-leader with an elastic net, so
most stay at zero, and a temperature calibrates the probabilities on rows kept back.

The model is fitted on a bounded sample of labelled rows (``SAMPLE_PER_LANGUAGE``); its
size does not depend on the corpus.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarrylake.llm.common import arrow_map, text_or_empty

BITS = 16
ORDERS = 3
#: Bound of the labelled rows that a language gives to the fit.
SAMPLE_PER_LANGUAGE = 1000
EPOCHS, ALPHA, BETA, L1, L2 = 3, 0.5, 1.0, 0.002, 0.001
#: Every fifth row of the sample is kept back for the temperature.
KEPT_BACK = 5
SCALE = 20.0
UNKNOWN = "und"
_ODD = (np.uint32(0x85EBCA6B), np.uint32(0xC2B2AE35), np.uint32(0x27D4EB2F))


def features(text: str) -> np.ndarray:
    """Bucket of every character n-gram of the text, in order, orders one after another."""
    codes = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "replace"), np.uint32)
    out = []
    total = np.zeros(len(codes), np.uint32)
    for order in range(min(ORDERS, len(codes))):
        total = total[: len(codes) - order] * np.uint32(0x01000193) + codes[order:] * _ODD[order]
        h = total ^ (total >> np.uint32(15))
        out.append((h * np.uint32(0x9E3779B1)) >> np.uint32(32 - BITS))
    return np.concatenate(out)


@dataclass
class Model:
    languages: list[str]
    weights: np.ndarray  # bucket x language, with the inverse document frequency in it
    bias: np.ndarray
    temperature: float = 1.0

    def logits(self, text: str) -> np.ndarray:
        found = features(text)
        return self.weights[found].sum(axis=0) * (SCALE / len(found)) + self.bias

    def probabilities(self, text: str) -> np.ndarray:
        return softmax(self.logits(text) / self.temperature)


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max())
    return e / e.sum()


def fit_rows(rows: list[tuple[str, str]], idf: np.ndarray) -> Model:
    """Follow-the-regularised-leader over (text, language) rows."""
    languages = sorted({language for _, language in rows})
    number = {language: at for at, language in enumerate(languages)}
    rows = [rows[i] for i in np.random.default_rng(7).permutation(len(rows))]
    n = np.zeros(((1 << BITS) + 1, len(languages)))
    z = np.zeros_like(n)
    coded = []
    for text, language in rows:
        found = features(text)
        keys, counts = np.unique(found, return_counts=True)
        x = np.append(counts * idf[keys] * (SCALE / len(found)), 1.0)
        coded.append((np.append(keys, 1 << BITS).astype(np.int64), x, number[language]))

    def weights(n, z):
        return -np.sign(z) * np.maximum(np.abs(z) - L1, 0) / ((BETA + np.sqrt(n)) / ALPHA + L2)

    kept = len(rows) // KEPT_BACK if len(rows) >= 2 * KEPT_BACK else 0
    for _ in range(EPOCHS):
        for keys, x, label in coded[kept:]:
            n_own, z_own = n[keys], z[keys]
            w = weights(n_own, z_own)
            error = softmax(x @ w)
            error[label] -= 1
            gradient = x[:, None] * error
            grown = n_own + gradient**2
            z[keys] = z_own + gradient - (np.sqrt(grown) - np.sqrt(n_own)) / ALPHA * w
            n[keys] = grown
    w = weights(n, z)
    model = Model(languages, (w[:-1] * idf[:, None]).astype(np.float32), w[-1].astype(np.float32))
    if kept:
        logits = np.array([x @ w[keys] for keys, x, _ in coded[:kept]])
        labels = np.array([label for _, _, label in coded[:kept]])

        def loss(t: float) -> float:
            scaled = logits / t
            top = scaled.max(axis=1)
            return float((np.log(np.exp(scaled - top[:, None]).sum(axis=1)) + top - scaled[np.arange(kept), labels]).mean())

        model.temperature = float(min(np.geomspace(0.05, 20, 121), key=loss))
    return model


def document_frequencies(docs: DataFrame) -> DataFrame:
    """(bucket, n): documents whose text has an n-gram of the bucket; bucket -1 counts documents."""

    def run(batches):
        total, seen, count = np.zeros(1 << BITS, np.int64), np.zeros(1 << BITS, bool), 0
        for batch in batches:
            for text in batch.column(0):
                seen[features(text.as_py())] = True
                total += seen
                seen[:] = False
                count += 1
        if count:
            keys = np.flatnonzero(total)
            yield {"bucket": np.append(keys, -1), "n": np.append(total[keys], count)}

    counted = arrow_map(docs.select(text_or_empty("text").alias("text")), run, "bucket int, n long")
    return counted.groupBy("bucket").agg(F.sum("n").alias("n"))


def fit(training: DataFrame, sample_per_language: int = SAMPLE_PER_LANGUAGE) -> Model | None:
    """The model of (text, lang) rows; None if no row has a language and text with a letter.

    Document frequencies count all rows. The fit takes about ``sample_per_language`` rows
    of each language (all, if fewer), chosen by a hash of their text.
    """
    labelled = training.where(F.col("lang").isNotNull()).select(
        F.col("lang").cast("string").alias("lang"), text_or_empty("text").alias("text")
    )
    labelled = labelled.where(F.col("text").rlike(r"\p{L}"))
    counts = {row["lang"]: row["n"] for row in labelled.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return None
    idf = np.zeros(1 << BITS)
    counted = {row["bucket"]: row["n"] for row in document_frequencies(labelled).collect()}
    documents = counted.pop(-1)
    keys = np.fromiter(counted.keys(), np.int64, len(counted))
    idf[keys] = np.log((1 + documents) / (1 + np.fromiter(counted.values(), np.float64, len(counted)))) + 0.1
    share = F.create_map(*[F.lit(v) for lang, n in counts.items() for v in (lang, min(1.0, sample_per_language / n))])
    chance = F.pmod(F.xxhash64("text"), F.lit(1 << 20)) / F.lit(float(1 << 20))
    rows = labelled.where(chance < share[F.col("lang")]).select("text", "lang").collect()
    rows = sorted((r["text"], r["lang"]) for r in rows)
    return fit_rows(rows, idf) if rows else None


def predict(docs: DataFrame, model: Model | None, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(the id, lang_pred, score) per row: the likeliest language and its probability.

    A text that is null or has no letter is ``und`` with score 0, and so is every text
    without a model. Other columns are not read.
    """
    kind = docs.schema[id_column].dataType.simpleString()
    held = docs.sparkSession.sparkContext.broadcast(model)  # of fixed size

    def run(batches):
        model = held.value
        for batch in batches:
            names, scores = [], []
            for text, letters in zip(batch.column(1), batch.column(2).to_pylist()):
                if not letters or model is None:
                    names.append(UNKNOWN)
                    scores.append(0.0)
                    continue
                p = model.probabilities(text.as_py())
                best = int(p.argmax())
                names.append(model.languages[best])
                scores.append(float(p[best]))
            yield {"doc_id": batch.column(0), "lang_pred": names, "score": scores}

    text = text_or_empty(text_column)
    return arrow_map(
        docs.select(docs[id_column].alias("doc_id"), text.alias("text"), text.rlike(r"\p{L}").alias("letters")),
        run,
        f"doc_id {kind}, lang_pred string, score double",
    )
