"""Audit of how far the sources of a language diverge, from stripes folded in the mappers.

Each partition folds whole documents into hash stripes, term -> (documents, occurrences by source),
and spills them as rows when they hold many entries. Spilled stripes are merged by key: entries are
summed per (lang, term, source), with partial sums before the shuffle, so a frequent term costs no
task more than one entry per source and partition; then a term's entries become its merged stripe.
Stripes of terms in enough documents are dealt in blocks of about 4096 terms, each block is cogrouped
with the totals of its language's groups and gives its share of all divergences at once.

p of a term in a group is 1 + floor(10^9 (count + 2) / (N + 2 V)), N the occurrences of the V kept
terms in the group; a divergence is floor((p - q)^2 / (p + q)). All of it is exact integer arithmetic.

* Null text, lang and source count as empty strings. A text without terms still makes its group occur.
* Equal rows count as often as they occur. A language without kept terms has pairs of value 0 and no
  terms. A language with one source has no pairs. An empty table gives no rows.
* Ties in value rank by the item's UTF-8 bytes. Only text, lang and source are read; other columns,
  whatever their names, take no part.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarrylake.llm.common import arrow_map, findable, text_or_empty, written

#: Letters A-Z in lower case, a-z and all bytes of characters beyond ASCII; any other byte is a space.
LETTERS = bytes(
    code + 32 if 0x41 <= code <= 0x5A else code if 0x61 <= code <= 0x7A or code >= 0x80 else 0x20 for code in range(256)
)
#: Entries (term and source) that a mapper holds before it spills.
HELD = 500_000
#: Kept terms in a block, on average.
TERMS = 4096
#: Cells of the matrix (terms by sources) that a block works on at once.
CELLS = 1 << 18
SCALE = 1_000_000_000


def _stripes(most: int, batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    counts: dict[str, dict[str, Counter]] = {}
    docs: dict[str, Counter] = {}
    entries = 0
    for batch in batches:
        for lang, source, text in zip(*(batch.column(name).to_pylist() for name in ("lang", "source", "text"))):
            terms = text.encode("utf-8", "replace").translate(LETTERS).split()
            count = counts.setdefault(lang, {}).setdefault(source, Counter())
            known = len(count)
            count.update(terms)
            docs.setdefault(lang, Counter()).update(set(terms))
            entries += len(count) - known
            if entries >= most:
                yield from _spilled(docs, counts)
                counts, docs, entries = {}, {}, 0
    yield from _spilled(docs, counts)


def _spilled(docs: dict[str, Counter], counts: dict[str, dict[str, Counter]]) -> Iterator[dict]:
    """The stripes as rows of (lang, term, docs, sources, counts), a bounded number at a time."""
    for lang, by_term in docs.items():
        stripes: dict[bytes, tuple[list, list]] = {term: ([], []) for term in by_term}
        for source, count in counts[lang].items():
            for term, n in count.items():
                sources, occurrences = stripes[term]
                sources.append(source)
                occurrences.append(n)
            count.clear()
        rows = list(stripes.items())
        for start in range(0, len(rows), 20_000):
            part = rows[start : start + 20_000]
            yield {
                "lang": [lang] * len(part),
                "term": [term.decode("utf-8", "replace") for term, _ in part],
                "docs": [by_term[term] for term, _ in part],
                "sources": [stripe[0] for _, stripe in part],
                "counts": [stripe[1] for _, stripe in part],
            }


def stripes(docs: DataFrame, least_docs: int, held: int = HELD) -> DataFrame:
    """(lang, term, df, stripe): merged stripes (source, count) of the terms in at least so many documents."""
    texts = docs.select(*(text_or_empty(name).alias(name) for name in ("lang", "source", "text")))
    spilled = arrow_map(texts, partial(_stripes, held), "lang string, term string, docs bigint, sources array<string>, counts array<bigint>")
    entry = F.posexplode(F.arrays_zip("sources", "counts")).alias("place", "entry")
    summed = (
        spilled.select("lang", "term", "docs", entry)
        .groupBy("lang", "term", F.col("entry.sources").alias("source"))
        .agg(F.sum(F.when(F.col("place") == 0, F.col("docs")).otherwise(0)).alias("docs"), F.sum("entry.counts").alias("count"))
    )
    merged = summed.groupBy("lang", "term").agg(
        F.sum("docs").alias("df"), F.collect_list(F.struct("source", "count")).alias("stripe")
    )
    return merged.where(F.col("df") >= least_docs)


def _share(counts: np.ndarray, total: np.ndarray) -> np.ndarray:
    """1 + floor(SCALE * (counts + 2) / total), digit by digit in base 1000, so that nothing overflows."""
    rest, whole = counts + 2, np.zeros(np.broadcast(counts, total).shape, np.int64)
    for _ in range(3):
        rest = rest * 1000
        whole = whole * 1000 + rest // total
        rest = rest % total
    return whole + 1


def _block(terms: pd.DataFrame, groups: pd.DataFrame, top: int, cells: int) -> pd.DataFrame:
    """A block's sum for every pair of sources and its best terms of every source."""
    groups = groups.sort_values("source")
    sources = list(groups["source"])
    lang, kept = groups["lang"].iloc[0], int(groups["kept"].iloc[0])
    known = groups["occurs"].to_numpy(np.int64)
    place = {source: i for i, source in enumerate(sources)}
    sums = np.zeros((len(sources), len(sources)), np.int64)
    best: list[tuple] = []
    names = list(terms["term"])
    step = max(1, cells // len(sources))
    for start in range(0, len(names), step):
        part = names[start : start + step]
        counts = np.zeros((len(part), len(sources)), np.int64)
        for row, stripe in enumerate(terms["stripe"].iloc[start : start + step]):
            for entry in stripe:
                counts[row, place[entry["source"]]] = entry["count"]
        p = _share(counts, known + 2 * kept)
        whole = _share(counts.sum(1), known.sum() + 2 * kept)
        for i in range(len(sources)):
            apart = p - p[:, i : i + 1]
            sums[i] += (apart * apart // (p + p[:, i : i + 1])).sum(0)
            here = np.flatnonzero((counts[:, i] > 0) & (p[:, i] > whole))
            value = (p[here, i] - whole[here]) ** 2 // (p[here, i] + whole[here])
            ranked = sorted(zip((-value).tolist(), (part[j].encode() for j in here)))[:top]
            best += [(sources[i], item.decode(), -value) for value, item in ranked]
    rows = [(lang, sources[i], "pair", sources[j], int(sums[i, j])) for i in range(len(sources)) for j in range(len(sources)) if i != j]
    rows += [(lang, source, "term", item, value) for source, item, value in best]
    return pd.DataFrame(rows, columns=["lang", "source", "part", "item", "value"])


def audit(
    docs: DataFrame, least_docs: int = 10, top: int = 10, held: int = HELD, terms_per_block: int = TERMS, cells: int = CELLS
) -> DataFrame:
    """(lang, source, part, item, value, rank): divergence from every other source, and the terms that set a source apart."""
    findable(docs.sparkSession)
    merged = written(stripes(docs, least_docs, held), "divergence-stripes")
    occurring = docs.select(text_or_empty("lang").alias("lang"), text_or_empty("source").alias("source")).distinct()
    counted = (
        merged.select("lang", F.explode("stripe").alias("entry"))
        .groupBy("lang", F.col("entry.source").alias("source"))
        .agg(F.sum("entry.count").alias("occurs"))
    )
    kept = merged.groupBy("lang").agg(F.count(F.lit(1)).alias("kept"))
    groups = (
        occurring.join(counted, ["lang", "source"], "left")
        .join(kept, "lang", "left")
        .select(
            "lang", "source",
            F.coalesce("occurs", F.lit(0)).alias("occurs"),
            F.coalesce("kept", F.lit(0)).alias("kept"),
        )
        .withColumn("blocks", F.greatest(F.lit(1), F.ceil(F.col("kept") / terms_per_block)).cast("long"))
    )
    groups = written(groups, "divergence-groups")
    block = F.pmod(F.xxhash64("term"), F.col("blocks")).alias("block")
    blocks = groups.select("lang", "blocks").distinct()
    left = merged.join(blocks, "lang").select("lang", block, "term", "stripe")
    right = groups.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    shares = (
        left.groupBy("lang", "block")
        .cogroup(right.groupBy("lang", "block"))
        .applyInPandas(
            lambda terms, totals: _block(terms, totals, top, cells),
            "lang string, source string, part string, item string, value long",
        )
    )
    shares = written(shares, "divergence-shares")
    pairs = shares.where("part = 'pair'").groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    terms = shares.where("part = 'term'").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return pairs.withColumn("rank", F.row_number().over(order)).unionByName(terms)
