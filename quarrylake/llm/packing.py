"""Packing of documents into training windows of several sizes.

Hierarchical multi-length packing. A document's token ids are first cut into windows of
the longest size; what is left is routed to the tier of the smallest window that takes
it. Tiers are packed from long to short: a window opens with the longest waiting piece
of its tier, its gap takes the largest shorter pieces that fit, and the last gap is
closed by cutting a piece in two. So windows are full, and only the end of a partition
leaves a rest, which goes to ever shorter power-of-two windows. Full windows of one size
are dealt to steps of equal token count, in snake order of their attention cost.

Each partition of the input packs on its own, in one pass and without a shuffle, with a
bounded pool of waiting pieces. The layout depends on nothing but the rows of the
partition in their order, so a lost task gives the same windows again.
"""

from __future__ import annotations

import os
import struct
from bisect import bisect_right, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame

from quarrylake.llm.common import arrow_map, text_or_empty

TIERS = (256, 512, 1024, 2048, 4096)
END_ID = 2
POOL_TOKENS = 64 * 4096
STEP_TOKENS = 16 * 4096
#: Steps of one window size that are balanced against each other.
STEPS_AT_ONCE = 4
#: Longer words are not remembered.
LONGEST = 64
#: Text whose words are looked up together, words dealt to their places at once, words in one call of the tokenizer.
BYTES_AT_ONCE, WORDS_AT_ONCE, ASKED_AT_ONCE = 4 << 20, 1 << 20, 4096


class CachedTokenizer:
    """Token ids of texts as little-endian 32-bit numbers, remembered by white-space separated word.

    Right for tokenizers that lower-case, never join characters across ASCII white space and
    part a letter a-z from a full stop or comma after it. Two generations of about ``size`` words
    are kept, of at most ``LONGEST`` characters each.
    """

    def __init__(self, path: str, size: int = 600_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._tokenizer, self._size = Tokenizer.from_file(path), size
        self._young: dict[str, bytes] = {}
        self._old: dict[str, bytes] = {}

    def encode(self, text: str) -> bytes:
        return next(self.encode_all(pa.array([text])))

    def encode_all(self, texts: pa.Array) -> Iterator[bytes]:
        """The ids of each text. Different words are looked up once; Arrow and numpy deal them to their places."""
        if len(self._young) > self._size:
            self._old, self._young = self._young, {}
        # gives an array of its own: Arrow folds the case of a slice wrongly
        apart = pc.replace_substring_regex(texts.cast(pa.large_string()), "([A-Za-z])([.,])", r"\1 \2")
        # a special token's string is told from ordinary text before case is folded
        if not pc.any(pc.match_substring(apart, "<|")).as_py():
            apart = pc.ascii_lower(apart)
        split = pc.ascii_split_whitespace(apart)
        coded = split.flatten().dictionary_encode()
        found = self._lookup(coded.dictionary.to_pylist())
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
        starts = np.cumsum(sizes) - sizes
        pool, places = np.frombuffer(b"".join(found), "<u4"), coded.indices.to_numpy()
        # some words at a time: places take more room than ids
        ids = [np.empty(0, "<u4")]
        for at in range(0, len(places), WORDS_AT_ONCE):
            some = places[at : at + WORDS_AT_ONCE]
            lengths = sizes[some]
            ends = np.cumsum(lengths)
            ids.append(pool[np.arange(ends[-1]) + np.repeat(starts[some] - ends + lengths, lengths)])
        every = np.concatenate(ids)
        bounds = np.concatenate([[0], np.cumsum(sizes[places])])[split.offsets.to_numpy() - split.offsets[0].as_py()]
        for start, end in zip(bounds[:-1], bounds[1:]):
            yield every[start:end].tobytes()

    def _lookup(self, words: list[str]) -> list[bytes]:
        found = list(map(self._young.get, words))
        missing = [at for at, ids in enumerate(found) if ids is None]
        new = []
        for at in missing:
            ids = self._old.get(words[at])
            if ids is None:
                new.append(at)
            else:
                found[at] = self._young[words[at]] = ids
        for start in range(0, len(new), ASKED_AT_ONCE):
            asked = new[start : start + ASKED_AT_ONCE]
            answers = self._tokenizer.encode_batch_fast([words[at] for at in asked], add_special_tokens=False)
            for at, answer in zip(asked, answers):
                ids = answer.ids
                found[at] = ids = struct.pack(f"<{len(ids)}I", *ids)
                if len(words[at]) <= LONGEST:
                    self._young[words[at]] = ids
        return found


def _slices(batch: pa.RecordBatch, size: int) -> Iterator[pa.RecordBatch]:
    """Neighbouring rows with about ``size`` bytes of text or less; a longer text stands alone."""
    lengths = pc.binary_length(batch.column(1)).to_numpy(zero_copy_only=False)
    start = held = 0
    for at, length in enumerate(lengths.tolist()):
        if at > start and held + length > size:
            yield batch.slice(start, at - start)
            start, held = at, 0
        held += length
    if start < len(lengths):
        yield batch.slice(start)


_tokenizers: dict[str, CachedTokenizer] = {}


def tokenizer(path: str) -> CachedTokenizer:
    """One tokenizer per worker process, whose memory serves all its tasks."""
    if path not in _tokenizers:
        _tokenizers[path] = CachedTokenizer(path)
    return _tokenizers[path]


class _Packer:
    """Packs pieces (doc_id, start, ids, doc_tokens) of one partition into windows."""

    def __init__(self, tiers: tuple[int, ...], pool_tokens: int, step_tokens: int, shard: int):
        self.tiers, self.pool_tokens, self.step_tokens = sorted(tiers), pool_tokens, step_tokens
        self.order: list[tuple[int, int]] = []  # (length, key), ascending
        self.pieces: dict[int, tuple] = {}
        self.waiting = self.key = 0
        self.full: dict[int, list] = {}
        self.next_id = self.next_step = shard << 36

    def add(self, doc_id, ids: bytes) -> Iterator[tuple]:
        tokens, longest = len(ids) // 4, self.tiers[-1]
        start = 0
        while tokens - start >= longest:
            yield from self._close(longest, [(doc_id, start, ids[4 * start : 4 * (start + longest)], tokens)])
            start += longest
        if start < tokens:
            self._wait((doc_id, start, ids[4 * start :], tokens))
        if self.waiting > self.pool_tokens:
            while self.waiting > self.pool_tokens // 2:
                yield from self._next_window()

    def finish(self) -> Iterator[tuple]:
        while self.waiting >= self._tier(self.order[-1][0] if self.order else 1):
            yield from self._next_window()
        size = self.tiers[-1]
        while self.waiting:
            while size > self.waiting:
                size //= 2
            yield from self._close(size, self._fill(size, []))
        for size in list(self.full):
            yield from self._deal(size)

    def _tier(self, length: int) -> int:
        return next(t for t in self.tiers if t >= length)

    def _wait(self, piece: tuple) -> None:
        self.key += 1
        self.pieces[self.key] = piece
        insort(self.order, (len(piece[2]) // 4, self.key))
        self.waiting += len(piece[2]) // 4

    def _take(self, at: int) -> tuple:
        length, key = self.order.pop(at)
        self.waiting -= length
        return self.pieces.pop(key)

    def _next_window(self) -> Iterator[tuple]:
        """The longest waiting piece opens a window of its tier; shorter ones fill the gap."""
        tier = self._tier(self.order[-1][0])
        yield from self._close(tier, self._fill(tier, [self._take(-1)]))

    def _fill(self, size: int, inside: list[tuple]) -> list[tuple]:
        gap = size - sum(len(p[2]) // 4 for p in inside)
        while gap:
            at = bisect_right(self.order, (gap, self.key + 1)) - 1
            piece = self._take(max(at, 0))
            if at < 0:  # nothing fits: cut the shortest piece
                doc_id, start, ids, tokens = piece
                piece = (doc_id, start, ids[: 4 * gap], tokens)
                self._wait((doc_id, start + gap, ids[4 * gap :], tokens))
            inside.append(piece)
            gap -= len(piece[2]) // 4
        return inside

    def _close(self, size: int, inside: list[tuple]) -> Iterator[tuple]:
        windows = self.full.setdefault(size, [])
        windows.append(inside)
        if len(windows) >= max(1, self.step_tokens // size) * STEPS_AT_ONCE:
            yield from self._deal(size)

    def _deal(self, size: int) -> Iterator[tuple]:
        """Windows of one size to steps: costliest first, forwards and backwards in turn."""
        windows = sorted(self.full.pop(size, []), key=lambda w: -sum((len(p[2]) // 4) ** 2 for p in w))
        steps = -(-len(windows) // max(1, self.step_tokens // size))
        for at, window in enumerate(windows):
            turn, place = divmod(at, steps)
            step = self.next_step + (steps - 1 - place if turn % 2 else place)
            offset = 0
            for doc_id, start, ids, tokens in window:
                length = len(ids) // 4
                yield doc_id, start, length, tokens, ids, self.next_id, offset, size, step
                offset += length
            self.next_id += 1
        self.next_step += steps


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    id_column: str = "doc_id",
    text_column: str = "text",
    tiers: tuple[int, ...] = TIERS,
    end_id: int = END_ID,
    pool_tokens: int = POOL_TOKENS,
    step_tokens: int = STEP_TOKENS,
) -> DataFrame:
    """Pieces of all documents, laid out in windows.

    Columns: the id, start (ids of the document before the piece), length, doc_tokens,
    ids (little-endian unsigned 32-bit numbers), sequence_id, offset in the window,
    window_size, step_id. ``tiers`` are powers of two, each twice the one before.

    A null or empty text is the end id alone. Rows that repeat an id are documents of
    their own. A null id stays null. Other columns of the input are not read; an empty
    table gives no pieces.
    """
    if sorted(tiers) != [min(tiers) << i for i in range(len(tiers))] or min(tiers) & (min(tiers) - 1):
        raise ValueError("tiers are powers of two, each twice the one before")
    end = end_id.to_bytes(4, "little")
    names = ("doc_id", "start", "length", "doc_tokens", "ids", "sequence_id", "offset", "window_size", "step_id")

    def run(batches):
        packer = _Packer(tiers, pool_tokens, step_tokens, TaskContext.get().partitionId())
        coder, rows, size = tokenizer(tokenizer_path), [], 0

        def pieces():
            for batch in batches:
                for some in _slices(batch, BYTES_AT_ONCE):
                    for doc_id, ids in zip(some.column(0).to_pylist(), coder.encode_all(some.column(1))):
                        yield from packer.add(doc_id, ids + end)
            yield from packer.finish()

        for piece in pieces():
            rows.append(piece)
            size += piece[2]
            if size > 1 << 20:
                yield dict(zip(names, map(list, zip(*rows))))
                rows, size = [], 0
        if rows:
            yield dict(zip(names, map(list, zip(*rows))))

    kind = docs.schema[id_column].dataType.simpleString()
    return arrow_map(
        docs.select(docs[id_column].alias("doc_id"), text_or_empty(text_column).alias("text")),
        run,
        f"doc_id {kind}, start long, length long, doc_tokens long, ids binary, sequence_id long,"
        " offset long, window_size long, step_id long",
    )
