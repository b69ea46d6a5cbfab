"""Removal of passages that repeat across documents: similar paragraphs, and equal runs of words anywhere.

A paragraph is a line of at least ``MIN_WORDS`` words, sketched by MinHash over its five-word
shingles. The bands are tuned to find a pair at the threshold with high probability.
Paragraphs that share a band are joined, the exact Jaccard similarity of their shingles is
verified, and each component of the links keeps its first paragraph. Paragraphs with the
same words in the same order are merged before all this.

Equal passages are found whatever the lines (``spans``). Of the windows of ``WINDOW`` words of a whole text those are
taken whose first shingle has the least hash among ``REACH`` neighbours. The choice depends on
the words alone, so a run of ``WINDOW + REACH - 1`` words that two texts share gives both the
same window. Each window that an earlier place has too is extended to both sides as far as the words are
equal.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarrylake.llm.bandjoin import components
from quarrylake.llm.common import arrow_map, joined, mixed, shingles_of, text_or_empty, words_of, written

SHINGLE, THRESHOLD = 5, 0.8
MIN_WORDS = 25
#: Words of a window, and neighbouring windows of which one is taken: runs of 37 equal words and more are always found.
WINDOW, REACH = 25, 13
#: Share of pairs at the threshold that share a band, at least, and of pairs at 0.3, at most.
RECALL, CHANCE = 0.9995, 0.3
#: Shingles that are sketched in one go, and different ones that are counted in one go where blocks are compared.
SKETCHED, COLUMNS = 2048, 8192


def tune(threshold: float = THRESHOLD, recall: float = RECALL, chance: float = CHANCE, low: float = 0.3) -> tuple[int, int]:
    """(bands, rows): fewest bands that reach the recall and keep pairs at ``low`` below ``chance``."""
    for rows in range(1, 33):
        bands = math.ceil(math.log(1 - recall) / math.log(1 - threshold**rows))
        if 1 - (1 - low**rows) ** bands <= chance:
            return bands, rows
    raise ValueError("no banding reaches this recall")


def paragraphs(raw: bytes, places: np.ndarray) -> tuple[np.ndarray, ...]:
    """Of each paragraph of joined texts that start at ``places``: its text, its line there, its first word and number of words; and all words."""
    words, starts, _ = words_of(raw)
    feeds = np.flatnonzero(np.frombuffer(raw, np.uint8) == 10)
    line = np.searchsorted(feeds, starts)
    first = np.flatnonzero(np.append(True, line[1:] != line[:-1])) if len(line) else np.empty(0, np.int64)
    count = np.diff(np.append(first, len(line)))
    long_enough = count >= MIN_WORDS
    first, count = first[long_enough], count[long_enough]
    text = np.searchsorted(places, starts[first], side="right") - 1
    return text, line[first] - np.searchsorted(feeds, places[text]), first, count, words


def _runs(first: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The numbers first, first + 1, ... of each run, one run after the other, and where each run starts."""
    begins = np.cumsum(count) - count
    return np.arange(count.sum()) + np.repeat(first - begins, count), begins


def contents_of(words: np.ndarray, first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """A number for the sequence of words of each paragraph, of one at least."""
    at, begins = _runs(first, count)
    place = (at - np.repeat(first, count)).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return mixed(np.add.reduceat(mixed(words[at] + place), begins) + count.astype(np.uint64)).view(np.int64)


def sketches(words: np.ndarray, first: np.ndarray, count: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """Band values of the shingles of each paragraph, a row each."""
    seeds = np.random.default_rng(41).integers(1, 2**63, (2, bands * rows), dtype=np.uint64)
    seeds[1] |= np.uint64(1)
    found, count = shingles_of(words, SHINGLE), count - (SHINGLE - 1)
    least = np.empty((len(first), bands * rows), np.uint64)
    size = np.cumsum(count)
    begin = 0
    while begin < len(first):  # about so many shingles in one go
        end = max(begin + 1, int(np.searchsorted(size, (size[begin - 1] if begin else 0) + SKETCHED, side="right")))
        at, begins = _runs(first[begin:end], count[begin:end])
        least[begin:end] = np.minimum.reduceat((found[at][:, None] ^ seeds[0]) * seeds[1], begins, axis=0)
        begin = end
    least = least.reshape(-1, bands, rows)
    total = np.tile(np.arange(1, bands + 1, dtype=np.uint64), (len(first), 1))
    for row in range(rows):
        total = mixed(total * np.uint64(0xBF58476D1CE4E5B9) + least[:, :, row])
    return total.view(np.int64)


def jaccard(a: np.ndarray, b: np.ndarray) -> float:
    common = len(np.intersect1d(a, b, assume_unique=True))
    return common / (len(a) + len(b) - common)


def jaccards(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """``jaccard`` of all pairs: common members are counted by products of matrices, so many members at a time."""
    sizes = [np.array([len(x) for x in side]) for side in (left, right)]
    members = [np.concatenate(side) for side in (left, right)]
    owners = [np.repeat(np.arange(len(n)), n) for n in sizes]
    shared = np.intersect1d(*members)
    at = [np.minimum(np.searchsorted(shared, m), max(len(shared) - 1, 0)) for m in members]
    common = np.zeros((len(left), len(right)), np.float32)
    for begin in range(0, len(shared), COLUMNS):
        width = min(COLUMNS, len(shared) - begin)
        has = [np.zeros((len(n), width), np.float32) for n in sizes]
        for matrix, place, own, member in zip(has, at, owners, members):
            used = (place >= begin) & (place < begin + width) & (shared[place] == member)
            matrix[own[used], place[used] - begin] = 1
        common += has[0] @ has[1].T
    return common / np.maximum(sizes[0][:, None] + sizes[1] - common, 1)


def repeated(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, version, line_no, kept_doc_id, kept_line_no, class_id, words) of each paragraph that goes.

    Each class of similar paragraphs keeps the first one by document id (null first), version (the
    hash of the document's text) and line. ``class_id`` numbers the class. Rows that
    repeat id and text are one document. Shorter lines, null and empty texts have no
    paragraphs. Other columns are not read.
    """
    bands, rows = tune()
    texts = docs.select(docs[id_column].alias("doc_id"), text_or_empty(text_column).alias("text"))
    texts = texts.withColumn("version", F.xxhash64("text"))
    kind = texts.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            begin = 0
            for raw, starts in joined(batch.column(2).to_pylist()):
                text, line, first, count, words = paragraphs(raw, starts)
                if len(text):
                    values = sketches(words, first, count, bands, rows)
                    offsets = pa.array(np.arange(0, values.size + 1, bands), pa.int32())
                    yield {
                        "doc_id": batch.column(0).take(pa.array(text + begin)),
                        "version": batch.column(1).take(pa.array(text + begin)),
                        "line_no": line,
                        "words": count,
                        "content": contents_of(words, first, count),
                        "bands": pa.ListArray.from_arrays(offsets, pa.array(values.ravel())),
                    }
                begin += len(starts) - 1

    places = written(
        arrow_map(
            texts.select("doc_id", "version", "text"),
            run,
            f"doc_id {kind}, version long, line_no int, words int, content long, bands array<long>",
        ),
        "paragraphs",
    )
    place = F.struct("doc_id", "version", "line_no")
    contents = written(places.groupBy("content").agg(F.min(place).alias("first"), F.first("bands").alias("bands")), "paragraph-contents")

    def texts_of(wanted: DataFrame) -> DataFrame:
        """The line of each content, out of the first document that has it."""
        asked = (
            contents.join(wanted, "content", "left_semi")
            .groupBy(F.col("first.doc_id").alias("id"), F.col("first.version").alias("of"))
            .agg(F.collect_list(F.struct("content", "first.line_no")).alias("asked"))
        )
        found = texts.join(asked, texts["doc_id"].eqNullSafe(asked["id"]) & (texts["version"] == asked["of"]))
        lines = F.split("text", "\n")
        return (
            found.withColumn("lines", lines)
            .select(F.explode(F.transform("asked", lambda x: F.struct(x["content"].alias("content"), F.col("lines")[x["line_no"]].alias("text")))).alias("x"))
            .select("x.content", "x.text")
            .dropDuplicates(["content"])
        )

    roots = components(
        contents, texts_of, lambda text: np.unique(shingles_of(words_of(text)[0], SHINGLE)), jaccard, THRESHOLD, "passages", jaccards
    )
    named = contents.select("content", "first").join(roots, "content", "left").withColumn("root", F.coalesce("root", "content"))
    kept = named.groupBy("root").agg(F.min("first").alias("kept"))
    known = named.select("content", "root").join(kept, "root")
    return (
        places.select("doc_id", "version", "line_no", "words", "content")
        .join(known, "content")
        .where(place > F.col("kept"))
        .select(
            "doc_id",
            "version",
            "line_no",
            F.col("kept.doc_id").alias("kept_doc_id"),
            F.col("kept.line_no").alias("kept_line_no"),
            F.col("root").alias("class_id"),
            "words",
        )
        .distinct()
    )


def window_starts(hashes: np.ndarray) -> np.ndarray:
    """First words of the windows that are taken from a text; ``hashes``: of the first shingle of each window."""
    if not len(hashes):
        return np.empty(0, np.int64)
    if len(hashes) <= REACH:
        return np.array([hashes.argmin()])
    least = np.lib.stride_tricks.sliding_window_view(hashes, REACH).argmin(axis=1)
    return np.unique(least + np.arange(len(least)))


def window_contents(words: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """A number for the words of each window."""
    total = np.zeros(len(starts), np.uint64)
    for place in range(WINDOW):
        total += mixed(words[starts + place] + np.uint64(place * 0x9E3779B97F4A7C15 % 2**64))
    return mixed(total).view(np.int64)


def extended(own: np.ndarray, other: np.ndarray, at: np.ndarray, there: np.ndarray) -> np.ndarray:
    """(start, end, start in ``other``, seed) of the longest equal runs around places (own, other) of one window, a row each.

    The seed is the first one of the run.
    """
    out: list[tuple[int, int, int, int]] = []
    order = np.lexsort((at, at - there))
    shift, until, compared = None, 0, None
    for seed, a, b in zip(order.tolist(), at[order].tolist(), there[order].tolist()):
        if a - b == shift and a < until:
            continue
        if a - b != compared:  # the places where the texts differ, once for all seeds of a shift
            compared = a - b
            low = max(compared, 0)
            high = min(len(own), len(other) + compared)
            differ = np.flatnonzero(own[low:high] != other[low - compared : high - compared]) + low
        k = int(np.searchsorted(differ, a))
        start = int(differ[k - 1]) + 1 if k else low
        end = int(differ[k]) if k < len(differ) else high
        if end - a >= WINDOW:  # else two windows with one number
            out.append((start, end, start - compared, seed))
            shift, until = compared, end
    return np.array(out, np.int64).reshape(-1, 4)


def spans(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, version, line_no, start, end, kept_doc_id, kept_line_no, kept_start, class_id, words) of each run of
    at least ``WINDOW`` words that an earlier place has too.

    ``start`` and ``end`` are code points of the text; line numbers are those where the run starts. Runs
    go over line ends. The kept place is the first one, by document id (null first), version (the hash of
    the text) and word, that has the window around which the run was found; ``class_id`` numbers the window. A
    run can be listed in parts if its windows have different first places, and parts may overlap. A window that
    overlaps its own first place is not listed. Rows that repeat id and text are one document. Other columns are not read.
    """
    texts = docs.select(docs[id_column].alias("doc_id"), text_or_empty(text_column).alias("text"))
    texts = texts.withColumn("version", F.xxhash64("text"))
    kind = texts.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            begin = 0
            for raw, places in joined(batch.column(2).to_pylist()):
                words, starts, _ = words_of(raw)
                bounds = np.searchsorted(starts, places)
                hashes = shingles_of(words, SHINGLE)
                own = [window_starts(hashes[a : max(a, b - WINDOW + 1)]) for a, b in zip(bounds[:-1], bounds[1:])]
                rows = np.repeat(np.arange(len(own)), [len(o) for o in own])
                if len(rows):
                    at = np.concatenate(own)
                    yield {
                        "doc_id": batch.column(0).take(pa.array(rows + begin)),
                        "version": batch.column(1).take(pa.array(rows + begin)),
                        "at": at.astype(np.int32),
                        "content": window_contents(words, at + bounds[rows]),
                    }
                begin += len(places) - 1

    windows = arrow_map(texts.select("doc_id", "version", "text"), run, f"doc_id {kind}, version long, at int, content long")
    place = F.struct("doc_id", "version", "at")
    # one shuffle of the windows, not written and not joined with their firsts
    placed = windows.withColumn("first", F.min(place).over(Window.partitionBy("content")))
    overlaps = (
        F.col("doc_id").eqNullSafe(F.col("first.doc_id"))
        & (F.col("version") == F.col("first.version"))
        & (F.col("at") < F.col("first.at") + WINDOW)
    )
    later = placed.where((place > F.col("first")) & ~overlaps)
    pairs = written(
        later.groupBy(
            "doc_id", "version", F.col("first.doc_id").alias("kept_doc_id"), F.col("first.version").alias("kept_version")
        ).agg(F.collect_set(F.struct("at", F.col("first.at").alias("there"), "content")).alias("seeds")),
        "window-pairs",
    )
    asked = pairs.select("doc_id", "version").union(pairs.select("kept_doc_id", "kept_version")).distinct()
    asked = asked.select(F.col("doc_id").alias("id"), F.col("version").alias("of"))
    found = written(
        texts.join(asked, texts["doc_id"].eqNullSafe(asked["id"]) & (texts["version"] == asked["of"]), "left_semi").dropDuplicates(["doc_id", "version"]),
        "window-texts",
    )
    own = found.select(F.col("doc_id").alias("own_id"), F.col("version").alias("own_version"), F.col("text").alias("own_text"))
    other = found.select(F.col("doc_id").alias("other_id"), F.col("version").alias("other_version"), F.col("text").alias("other_text"))
    both = (
        pairs.join(own, pairs["doc_id"].eqNullSafe(own["own_id"]) & (pairs["version"] == own["own_version"]))
        .join(other, pairs["kept_doc_id"].eqNullSafe(other["other_id"]) & (pairs["kept_version"] == other["other_version"]))
        .select("doc_id", "version", "kept_doc_id", "seeds", "own_text", "other_text")
    )

    def places_of(text: str):
        raw = text.encode("utf-8", "replace")
        words, starts, ends = words_of(raw)
        data = np.frombuffer(raw, np.uint8)
        points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
        return words, points[starts], points[ends], np.searchsorted(np.flatnonzero(data == 10), starts)

    def extend(batches):
        for batch in batches:
            seeds = batch.column(3)
            bounds = seeds.offsets.to_numpy()
            at, there, content = (field.to_numpy() for field in seeds.values.flatten())
            out = []
            for row in range(batch.num_rows):
                words, starts, ends, lines = places_of(batch.column(4)[row].as_py())
                others, other_starts, _, other_lines = places_of(batch.column(5)[row].as_py())
                own = slice(bounds[row], bounds[row + 1])
                begin, end, kept, seed = extended(words, others, at[own], there[own]).T
                if len(begin):
                    places = (lines[begin], starts[begin], ends[end - 1], other_lines[kept], other_starts[kept])
                    out.append((np.full(len(begin), row), *places, content[own][seed], end - begin))
            if out:
                rows, *found = (np.concatenate(c) for c in zip(*out))
                names = ("line_no", "start", "end", "kept_line_no", "kept_start", "class_id", "words")
                ids = {c: batch.column(k).take(pa.array(rows)) for k, c in enumerate(("doc_id", "version", "kept_doc_id"))}
                yield ids | dict(zip(names, found))

    return arrow_map(
        both,
        extend,
        f"doc_id {kind}, version long, line_no int, start int, end int, kept_doc_id {kind}, kept_line_no int, kept_start int, class_id long, words int",
    )
