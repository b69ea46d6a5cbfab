"""Benchmark decontamination by SimHash of item-sized windows.

Every benchmark item has a fingerprint of 64 bits, the signs of the weighted sum of its
shingles' bits, and so has every window of a document with as many words as the item. The
fingerprints are cut into blocks; the index of a block holds each item under every
value close enough to its own. If two fingerprints differ in at most ``RADIUS`` bits, one of
their blocks differs in at most ``RADIUS / BLOCKS``, so looking up all blocks finds
every item within the radius. Those are verified by the exact weighted Jaccard
similarity of the shingles.

Only windows around a shingle that some item has are fingerprinted: any other window has
similarity 0. The items are handled in blocks of bounded size, each sent to all workers.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarrylake.llm.common import arrow_filter, arrow_map, mixed, shingles_of, text_or_empty, words_of
from quarrylake.llm.neardup import SHINGLE, bucket, inverse_frequencies, weighted_jaccard

THRESHOLD = 0.8
#: At similarity 0.8 fingerprints differ in about 10 bits, with a deviation of 3.
RADIUS, BLOCKS = 21, 8
ITEMS_AT_ONCE = 20_000
#: Windows start up to so many words beside where a shared shingle puts them.
SHIFT = 2
_FILTER_BITS = 22
_SEGMENT = 1 << 15
_NEAR = RADIUS // BLOCKS
_POPULATION = np.array([bin(v).count("1") for v in range(256)], np.uint8)


def _signs(found: np.ndarray) -> np.ndarray:
    """+1 or -1 for each of 64 bits of each shingle."""
    spread = mixed(found ^ np.uint64(0x5851F42D4C957F2D))
    return np.unpackbits(spread.view(np.uint8).reshape(-1, 8), axis=1).astype(np.float32) * 2 - 1


def _pack(sums: np.ndarray) -> np.ndarray:
    return np.packbits(sums > 0, axis=1)


@dataclass
class Items:
    """Benchmark items with their index."""

    ids: list
    words: np.ndarray  # number of words of each item
    sets: list  # (different shingles, weights) of each item
    prints: np.ndarray  # items x 8 bytes
    index: list  # of each block: by value, the items close to it
    keys: np.ndarray  # shingles of all items, ascending, with item and place
    owner: np.ndarray
    place: np.ndarray
    filter: np.ndarray

    @staticmethod
    def of(rows: list[tuple], idf: np.ndarray) -> Items:
        ids, counts, sets, prints, keys, owner, place = [], [], [], [], [], [], []
        for item_id, text in rows:
            words = words_of(text)[0]
            if not len(words):
                continue
            found = shingles_of(words, SHINGLE)
            at = len(ids)
            ids.append(item_id)
            counts.append(len(words))
            different = np.unique(found)
            sets.append((different, idf[bucket(different)]))
            prints.append(_pack((_signs(found) * idf[bucket(found)][:, None]).sum(axis=0)[None])[0])
            keys.append(found)
            owner.append(np.full(len(found), at))
            place.append(np.arange(len(found)))
        if not ids:
            return Items([], np.empty(0, int), [], np.empty((0, 8), np.uint8), [], np.empty(0, np.uint64), *[np.empty(0, int)] * 2, np.zeros(1 << _FILTER_BITS, bool))
        keys, owner, place = np.concatenate(keys), np.concatenate(owner), np.concatenate(place)
        order = np.argsort(keys, kind="stable")
        prints = np.array(prints)
        index = []
        for block in range(BLOCKS):
            near = _POPULATION[np.arange(256)[:, None] ^ prints[:, block]] <= _NEAR
            index.append([np.flatnonzero(row) for row in near])
        present = np.zeros(1 << _FILTER_BITS, bool)
        present[keys >> np.uint64(64 - _FILTER_BITS)] = True
        return Items(ids, np.array(counts), sets, prints, index, keys[order], owner[order], place[order], present)

    def matches(self, text: str | None, idf: np.ndarray) -> dict[int, tuple]:
        """Of each item found in the text: (similarity, first byte, end byte) of its most similar window."""
        words, starts, ends = words_of(text)
        found = shingles_of(words, SHINGLE)
        best: dict[int, tuple] = {}
        hits = np.flatnonzero(self.filter[found >> np.uint64(64 - _FILTER_BITS)])
        if not len(hits):
            return best
        low, high = np.searchsorted(self.keys, found[hits]), np.searchsorted(self.keys, found[hits], "right")
        many = high - low
        at = np.repeat(low, many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        if not len(at):
            return best
        item, first = self.owner[at], np.repeat(hits, many) - self.place[at]
        shifts = np.arange(-SHIFT, SHIFT + 1)
        size = np.repeat(self.words[item], len(shifts))
        first = np.clip((first[:, None] + shifts).ravel(), 0, np.maximum(len(words) - size, 0))
        windows = np.unique(np.column_stack([first, np.maximum(np.minimum(size, len(words)) - SHINGLE + 1, 1)]), axis=0)
        for begin in range(0, len(found), _SEGMENT):
            own = windows[(windows[:, 0] >= begin) & (windows[:, 0] < begin + _SEGMENT)]
            if len(own):
                self._search(found, own, begin, idf, best, starts, ends)
        return best

    def _search(self, found, windows, begin, idf, best, starts, ends):
        """Look up windows (first shingle, number of shingles) of one segment of a text."""
        stop = (windows[:, 0] + windows[:, 1]).max()
        part = found[begin:stop]
        sums = np.zeros((len(part) + 1, 64))
        np.cumsum(_signs(part) * idf[bucket(part)][:, None], axis=0, dtype=np.float64, out=sums[1:])
        for at in range(0, len(windows), 8192):
            some = windows[at : at + 8192]
            prints = _pack(sums[some[:, 0] + some[:, 1] - begin] - sums[some[:, 0] - begin])
            for (first, count), print_ in zip(some.tolist(), prints):
                near = np.unique(np.concatenate([self.index[b][v] for b, v in enumerate(print_)]))
                near = near[np.maximum(self.words[near] - SHINGLE + 1, 1) >= count]
                near = near[_POPULATION[self.prints[near] ^ print_].sum(axis=1, dtype=np.int64) <= RADIUS]
                if len(near):
                    keys = np.unique(found[first : first + count])
                    own = keys, idf[bucket(keys)]
                for item in near.tolist():
                    similarity = weighted_jaccard(own, self.sets[item])
                    if similarity >= THRESHOLD and similarity > best.get(item, (0,))[0]:
                        last = min(first + count + SHINGLE - 2, len(ends) - 1)
                        best[item] = similarity, int(starts[first]), int(ends[last])


def contaminated(
    docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """(doc_id, item_id, similarity, start, end): items that a document contains, with their place.

    ``start`` and ``end`` are code points of the text, of the window that is most similar. An item of
    fewer than five words is one shingle, and so only found where it is a whole text.
    Items without words, null texts and texts without words match nothing. Rows that
    repeat an id count as rows of their own; ``benchmark`` is (item_id, text). Other columns are not read.
    """
    rows = docs.select(docs[id_column].alias("doc_id"), text_or_empty(text_column).alias("text"))
    kinds = rows.schema["doc_id"].dataType.simpleString(), benchmark.schema["item_id"].dataType.simpleString()
    parts = [_found(rows, held, kinds) for held in _blocks(docs, benchmark)]
    return reduce(DataFrame.unionByName, parts)


def clean(docs: DataFrame, benchmark: DataFrame, text_column: str = "text") -> DataFrame:
    """The rows, with all their columns, whose text contains no item (see ``contaminated``)."""
    for held in _blocks(docs, benchmark):

        def keeper(held=held):
            items, idf = held.value
            return lambda texts: [not items.matches(text, idf) for text in texts]

        docs = arrow_filter(docs, text_column, keeper)
    return docs


def _blocks(docs: DataFrame, benchmark: DataFrame) -> list:
    """The items with their index as broadcast blocks of about ``ITEMS_AT_ONCE`` items."""
    items = benchmark.select("item_id", text_or_empty("text").alias("text"))
    idf = inverse_frequencies(items)
    blocks = max(1, -(-items.count() // ITEMS_AT_ONCE))
    out = []
    for block in range(blocks):
        chosen = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block)
        known = Items.of([(r["item_id"], r["text"]) for r in chosen.collect()], idf)
        out.append(docs.sparkSession.sparkContext.broadcast((known, idf)))
    return out


def _found(rows: DataFrame, held, kinds: tuple[str, str]) -> DataFrame:
    names = ("doc_id", "item_id", "similarity", "start", "end")

    def run(batches):
        items, idf = held.value
        for batch in batches:
            out = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                text = text.as_py()
                matches = items.matches(text, idf)
                raw = text.encode("utf-8", "replace") if matches else b""
                for item, (similarity, start, end) in matches.items():
                    start, end = (len(raw[:p].decode("utf-8", "replace")) for p in (start, end))
                    out.append((doc_id, items.ids[item], similarity, start, end))
            if out:
                yield dict(zip(names, map(list, zip(*out))))

    return arrow_map(rows, run, f"doc_id {kinds[0]}, item_id {kinds[1]}, similarity double, start long, end long")
