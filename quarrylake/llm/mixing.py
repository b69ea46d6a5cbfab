"""Language-model scores by logistic context mixing of bit predictors.

A text is a chain of units: a word with the white space byte after it, or with the end
mark. Bytes are coded bit by bit, most significant first. Several predictors, each with a hashed
context (the last 1, 2, 3 or 5 bytes of the text, across units, or all since the unit's start), hold
counts of zeros and ones. Their stretched predictions are combined by a logistic mixer whose
weights are picked by a gate (how far the contexts are known, and the bit's place), and an adaptive
map refines the result by the partial byte. Mixer and map learn over all training units, each as often as it
occurs and scored as if it occurred once less. The bits of a unit give its probability, and a text's is their product.

The mixer's weights are the maximum of a quadratic lower bound of the bits' log likelihood (logistic regression with the bound
of Jaakkola and Jordan). The bound is a sum over the bits, so parts of the units learn apart and their sums, of fixed
size, are added up. Within a part it is taken around the weights learned so far.

From its sixth byte on, a unit's contexts lie inside it, so there each different unit is scored once for the whole corpus.
The first five bytes of a unit also depend on what is before it: each is scored as a border, which is the five bytes of text before
the byte and the byte. There are few different borders, as there are few different runs of six bytes around the start of a word.

1. Every partition turns its texts into blocks: the block's different units and unit starts (five bytes before and the first five of the
   unit) and, per document, how often it has each of them.
2. Units and borders are summed over the blocks; words give the base model's counts, units and borders fill the
   predictors' tables, in parts that are added up. The tables have a fixed size.
3. Mixer and map learn on the different training units and borders, in parts that are added up.
4. Every different unit is scored from its sixth byte on and goes back to the blocks that have it; a block's borders are
   scored in the block; and the documents add up.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarrylake.llm.common import _power_tables, arrow_map, arrow_type, mixed, text_or_empty, written

BLOCK_BYTES = 32 << 20
#: Context length in bytes (None: since the start of the unit) and bits of the table.
CONTEXTS = ((1, 16), (2, 19), (3, 20), (5, 22), (None, 23))
PART_BITS = 14
UNITS_PER_PART, MOST_PARTS = 1_000_000, 256
#: Parts in which mixer and map learn, for each part of the tables.
LEARNERS = 2
#: Units that are scored or learned from in one go.
GATHERED = 16384
#: Counts of a slot in the finished tables.
MOST_SEEN = 65_535
#: First bytes of a unit whose contexts reach before it: as many as the longest context that crosses units.
NEAR = max(length or 0 for length, _ in CONTEXTS)
#: Bytes that no UTF-8 text has: the place before a text and after a unit's end, and the first byte of a border.
BLANK, BORDER = 0xFE, 0xFD
BINS = 24
#: Unit starts that are scored or gathered in one go.
STARTED = 1 << 19
#: Weight of the first guess of mixer and map, and how often the bound is taken anew around a batch's own weights: the first batch's
#: more often, as it starts from the first guess.
PRIOR, ROUNDS, FIRST_ROUNDS = 1.0, 1, 16
_UNIT = re.compile(rb"[^ \t-\r]*[ \t-\r\xff]")
_BEFORE_UNIT = np.isin(np.arange(256), [*b" \t\n\v\f\r", BLANK])
_BYTES = np.random.default_rng(51).integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)


def units_of(text: str) -> list[bytes]:
    """The units of a text, A-Z lower-cased; the last one ends with byte 255, which no UTF-8 text has."""
    return _UNIT.findall(text.encode("utf-8", "replace").lower() + b"\xff")


def starts_of(units: list[bytes]) -> np.ndarray:
    """Per unit of a text the NEAR bytes before it and its first NEAR bytes, BLANK where there are none (units x 2 NEAR)."""
    length = np.fromiter(map(len, units), np.int64, len(units))
    blank = bytes([BLANK]) * NEAR
    text = np.frombuffer(blank + b"".join(units) + blank, np.uint8)
    out = np.lib.stride_tricks.sliding_window_view(text, 2 * NEAR)[np.cumsum(length) - length]
    out[:, NEAR:][np.arange(NEAR) >= length[:, None]] = BLANK
    return out


def _wide(starts: np.ndarray) -> np.ndarray:
    """The unit starts as two numbers each."""
    wide = np.zeros((len(starts), 16), np.uint8)
    wide[:, : starts.shape[1]] = starts
    return wide.view(np.uint64)


def keys_of(starts: np.ndarray) -> np.ndarray:
    """A hash of each unit start."""
    wide = _wide(starts)
    return mixed(wide[:, 0] + mixed(wide[:, 1] + np.uint64(1)))


def borders_of(starts: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each of the first NEAR bytes of a unit: the unit starts that have it, and their borders as numbers."""
    for at in range(NEAR):
        rows = np.flatnonzero(starts[:, NEAR + at] != BLANK)
        numbers = np.zeros(len(rows), np.uint64)
        for k in range(NEAR + 1):
            numbers = numbers << np.uint64(8) | starts[rows, at + k].astype(np.uint64)
        yield rows, numbers


def pieces_of(borders: np.ndarray) -> np.ndarray:
    """The borders' bytes: BORDER, NEAR bytes of text and the byte after them."""
    out = np.empty((len(borders), NEAR + 2), np.uint8)
    out[:, 0] = BORDER
    out[:, 1:] = borders.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 7 - NEAR :]
    return out


def packed(numbers: np.ndarray, times: np.ndarray) -> bytes:
    """Ascending numbers and how often each occurs."""
    both = np.stack([np.diff(numbers, prepend=0), times]).astype("<u4")
    return zlib.compress(both.view(np.uint8).reshape(-1, 4).T.tobytes(), 1)


def unpacked(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    both = np.frombuffer(zlib.decompress(data), np.uint8).reshape(4, -1).T.copy().view("<u4").reshape(2, -1)
    return np.cumsum(both[0], dtype=np.int64), both[1].astype(np.float64)


@dataclass
class Bits:
    """Slots of every scored bit of some units and borders in every table: bytes x 8 per table."""

    text: np.ndarray  # all bytes
    at: np.ndarray  # where in it the scored ones are
    piece: np.ndarray  # the unit or border of each of these
    begin: np.ndarray  # where the text of each unit or border begins
    start: np.ndarray  # where its unit begins

    @staticmethod
    def of(units: list[bytes], skip: int = 0) -> Bits:
        """Of units, from their byte ``skip`` on, and of borders, which have one byte to score."""
        length = np.fromiter(map(len, units), np.int64, len(units))
        text = np.frombuffer(b"".join(units), np.uint8)
        begin = np.cumsum(length) - length
        start, scored = begin.copy(), begin + skip
        border = np.flatnonzero(length == NEAR + 2)
        border = border[text[begin[border]] == BORDER]
        if len(border):
            begin[border] += 1
            near = _BEFORE_UNIT[text[begin[border][:, None] + np.arange(NEAR)]]
            scored[border] = begin[border] + NEAR
            start[border] = scored[border] - np.argmax(near[:, ::-1], axis=1)
        piece = np.repeat(np.arange(len(units)), length)
        at = np.flatnonzero(np.arange(len(text)) >= scored[piece])
        return Bits(text, at, piece[at], begin, start)

    @property
    def data(self) -> np.ndarray:
        return self.text[self.at]

    def contexts(self) -> Iterator[np.ndarray]:
        """For each table the hash of each scored byte's context."""
        n = len(self.text)
        place = self.at - self.begin[self.piece]
        numbers = _BYTES[self.text]
        near = np.zeros(len(self.at), np.uint64)
        back = 0
        for length, _ in CONTEXTS:
            if length is None:
                power, inverse = _power_tables(n)
                sums = np.concatenate([[np.uint64(0)], np.cumsum(numbers * power[:n])])[:-1]
                start = self.start[self.piece]
                yield mixed((sums[self.at] - sums[start]) * inverse[start] + np.uint64(7))
                continue
            while back < length:
                back += 1
                near = near * np.uint64(0x9E3779B97F4A7C15) + np.where(place >= back, numbers[np.maximum(self.at - back, 0)], np.uint64(back))
            yield mixed(near + np.uint64(length))

    def slots(self, context: np.ndarray, bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For each of the 8 bits: slots in the table, and the bits."""
        data = self.data
        for at in range(8):
            partial = (1 << at) | (data.astype(np.uint64) >> np.uint64(8 - at))
            slot = ((context + partial * np.uint64(0xD6E8FEB86659FD93)) * np.uint64(0x2545F4914F6CDD1D)) >> np.uint64(64 - bits)
            yield slot.astype(np.int64), (data >> np.uint8(7 - at)) & np.uint8(1)


def batches_of(units: list, size: int = 1 << 18) -> Iterator[slice]:
    """Slices of units with about so many bytes."""
    begin = total = 0
    for at, unit in enumerate(units):
        if total and total + len(unit) > size:
            yield slice(begin, at)
            begin, total = at, 0
        total += len(unit)
    if begin < len(units):
        yield slice(begin, len(units))


def stretched(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    return np.log((ones + np.float32(0.4)) / (zeros + np.float32(0.4)))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


def gate(counts: list[np.ndarray], at: int) -> np.ndarray:
    """Weight set of each bit: longest context that is known, size of its count, first bits or later."""
    longest, size = np.zeros(counts[0].shape, np.int64), np.zeros(counts[0].shape, np.float32)
    for k, c in enumerate(counts):
        longest = np.where(c > 0, k + 1, longest)
        size = np.where(c > 0, c, size)
    return (longest * 8 + np.minimum(np.log2(size + 1), 7).astype(np.int64)) * 2 + (at > 2)


GATES = (len(CONTEXTS) + 1) * 8 * 2


def place(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The lower one of the map's two places around x, and the share of the upper one."""
    scaled = (np.clip(x, -11.9, 11.9) + 12) * ((BINS - 1) / 24)
    low = scaled.astype(np.int64)
    return low, scaled - low


@dataclass
class Model:
    inputs: list[np.ndarray]  # per table: stretched prediction of each slot
    counts: list[np.ndarray]  # per table: observations of each slot, up to 255
    weights: np.ndarray
    map: np.ndarray  # partial byte x bin: the refined prediction, stretched

    def refine(self, x: np.ndarray, partial: np.ndarray) -> np.ndarray:
        """The mean of the mixed and the mapped prediction."""
        low, share = place(x)
        found = self.map[partial, low] * (1 - share) + self.map[partial, low + 1] * share
        return (x + found) / 2

    def unit_scores(self, units: list[bytes], skip: int = 0) -> np.ndarray:
        """log10 probability of each unit from its byte ``skip`` on, and of each border's last byte."""
        out = [np.empty(0)]
        for part in batches_of(units):
            bits = Bits.of(units[part], skip)
            data = bits.data.astype(np.int64)
            streams = [bits.slots(c, size) for c, (_, size) in zip(bits.contexts(), CONTEXTS)]
            total = np.zeros(len(data))
            for at, row in enumerate(zip(*streams)):
                slots, bit = [r[0] for r in row], row[0][1]
                weights = self.weights[gate([c[s] for c, s in zip(self.counts, slots)], at)]
                x = sum(weights[:, k] * self.inputs[k][s] for k, s in enumerate(slots))
                partial = (1 << at) | (data >> (8 - at))
                x = self.refine(x, partial)
                total -= np.logaddexp(0, np.where(bit == 1, -x, x))
            out.append(np.bincount(bits.piece, total, len(bits.begin)) / np.log(10))
        return np.concatenate(out)

    def start_scores(self, starts: np.ndarray) -> np.ndarray:
        """log10 probability of the first NEAR bytes of units after the bytes before them; each different border is scored once."""
        total = np.zeros(len(starts))
        for rows, numbers in borders_of(starts):
            different, own = np.unique(numbers, return_inverse=True)
            pieces = pieces_of(different).tobytes()
            total[rows] += self.unit_scores([pieces[k : k + NEAR + 2] for k in range(0, len(pieces), NEAR + 2)])[own]
        return total


def count_tables(units: list[bytes], numbers: np.ndarray, tables: list[np.ndarray], skip: int = 0) -> None:
    """Add the bits of the units from byte ``skip`` on and of the borders, ``numbers`` times each, to the tables (slots x 2)."""
    for part in batches_of(units):
        bits = Bits.of(units[part], skip)
        many = numbers[part][bits.piece]
        for table, context, (_, size) in zip(tables, bits.contexts(), CONTEXTS):
            for slot, bit in bits.slots(context, size):
                np.add.at(table.reshape(-1), slot * 2 + bit, many)


def _halves(table: np.ndarray) -> np.ndarray:
    """Stretched predictions of a table's slots, a piece at a time to keep memory low."""
    out = np.empty(len(table), np.float16)
    for begin in range(0, len(table), 1 << 18):
        piece = table[begin : begin + (1 << 18)].astype(np.float32)
        out[begin : begin + len(piece)] = stretched(piece[:, 0], piece[:, 1])
    return out


def curvature(x: np.ndarray) -> np.ndarray:
    """Curvature of the quadratic lower bound of log(sigmoid) that touches it at x."""
    far = np.maximum(np.abs(x), 1e-6)
    return np.tanh(far / 2) / (2 * far)


class Learning:
    """Mixer and map learned over units and their numbers; those of parts are added up."""

    def __init__(self):
        width = len(CONTEXTS)
        self.precision = np.tile(PRIOR * np.eye(width), (GATES, 1, 1))  # per gate: sum of x x' by the bound's curvature
        self.pull = np.full((GATES, width), PRIOR / width)  # per gate: sum of (bit - 1/2) x
        self.weights = np.full((GATES, width), 1.0 / width)
        self.map = np.tile(np.linspace(-12, 12, BINS), (256, 1))
        self.mass = np.full(self.map.shape, PRIOR)
        self.started = False

    def see(self, tables: list[np.ndarray], units: list[bytes], numbers: np.ndarray, skip: int = 0) -> None:
        """Learn from units, from byte ``skip`` on, and borders, each ``numbers`` times and as if the tables had it once less."""
        for part in batches_of(units, 1 << 16):
            bits = Bits.of(units[part], skip)
            if not len(bits.at):
                continue
            many = numbers[part][bits.piece].astype(np.float64)
            streams = [bits.slots(c, size) for c, (_, size) in zip(bits.contexts(), CONTEXTS)]
            x, gates, y = np.empty((8, len(many), len(CONTEXTS)), np.float32), np.empty((8, len(many)), np.uint8), np.empty((8, len(many)), np.float32)
            partial = (1 << np.arange(8))[:, None] | (bits.data.astype(np.int64) >> (8 - np.arange(8))[:, None])
            for at, row in enumerate(zip(*streams)):
                y[at] = row[0][1]
                one, sizes = row[0][1].astype(bool), []
                for k, ((slot, _), table) in enumerate(zip(row, tables)):
                    zeros, ones = table[:, 0][slot].astype(np.float32), table[:, 1][slot].astype(np.float32)
                    zeros -= ~one & (zeros > 0)
                    ones -= one & (ones > 0)
                    x[at, :, k] = stretched(zeros, ones)
                    sizes.append(zeros + ones)
                gates[at] = gate(sizes, at)
            x, gates, y, partial, n = x.reshape(-1, len(CONTEXTS)), gates.ravel(), y.ravel(), partial.ravel(), np.tile(many, 8)
            order = np.argsort(gates, kind="stable")
            x, gates, y, partial, n = (v[order] for v in (x, gates, y, partial, n))
            starts = np.flatnonzero(np.append(True, gates[1:] != gates[:-1]))
            groups = [(gates[begin], slice(begin, end)) for begin, end in zip(starts, np.append(starts[1:], len(gates)))]
            inputs = [x[own].astype(np.float64) for _, own in groups]

            def mix() -> np.ndarray:
                return np.concatenate([own @ self.weights[g].astype(np.float32) for own, g in ((x[own], g) for g, own in groups)])

            touched = gates[starts]
            for (g, own), rows in zip(groups, inputs):
                self.pull[g] += (n[own] * (y[own] - 0.5)) @ rows
            before = self.precision[touched]
            for _ in range(ROUNDS if self.started else FIRST_ROUNDS):
                curved = n * curvature(mix())
                self.precision[touched] = before + np.stack([(rows.T * curved[own]) @ rows for (_, own), rows in zip(groups, inputs)])
                self.weights[touched] = np.linalg.solve(self.precision[touched], self.pull[touched][:, :, None])[:, :, 0]
            self._refine(mix(), partial, y, n)
            self.started = True

    def _refine(self, x: np.ndarray, partial: np.ndarray, y: np.ndarray, n: np.ndarray) -> None:
        low, share = place(x)
        found = self.map[partial, low] * (1 - share) + self.map[partial, low + 1] * share
        error, curved = n * (y - _sigmoid(found)), n * curvature(found)
        at = np.concatenate([partial * BINS + low, partial * BINS + low + 1])
        shares = np.concatenate([1 - share, share])
        self.mass += np.bincount(at, np.tile(curved, 2) * shares, self.mass.size).reshape(self.mass.shape)
        self.map += np.bincount(at, np.tile(error, 2) * shares, self.mass.size).reshape(self.mass.shape) / self.mass

    def dump(self) -> bytes:
        return zlib.compress(np.concatenate([v.ravel() for v in (self.precision, self.pull, self.mass, self.map)]).tobytes(), 1)

    @staticmethod
    def total(dumps: Iterable[bytes]) -> Learning:
        """What parts have learned together; the first guess counts once."""
        out = Learning()
        sizes = np.cumsum([out.precision.size, out.pull.size, out.mass.size])
        first = [v.copy() for v in (out.precision, out.pull, out.mass, out.map)]
        mapped = out.mass * out.map
        for dump in dumps:
            precision, pull, mass, found = np.split(np.frombuffer(zlib.decompress(dump), np.float64), sizes)
            out.precision += precision.reshape(out.precision.shape) - first[0]
            out.pull += pull.reshape(out.pull.shape) - first[1]
            own = mass.reshape(out.mass.shape) - first[2]
            out.mass += own
            mapped += own * found.reshape(out.map.shape)
        out.weights = np.linalg.solve(out.precision, out.pull[:, :, None])[:, :, 0]
        out.map = mapped / out.mass
        return out

    def model(self, tables: list[np.ndarray]) -> Model:
        return Model(
            [_halves(t) for t in tables],
            [np.minimum(t.sum(axis=1, dtype=np.int32), 255).astype(np.uint8) for t in tables],
            self.weights,
            self.map,
        )


def train(tables: list[np.ndarray], counted: list[tuple[bytes, int]]) -> Model:
    """Mixer and map learned over units (unit, times), in one part."""
    own = Learning()
    own.see(tables, [unit for unit, _ in counted], np.array([times for _, times in counted], np.int64))
    return own.model(tables)


def _blocks(docs: DataFrame) -> DataFrame:
    """Rows of four kinds, by block.

    unit: (number, unit, n: times in training). border: (unit: its piece, n), of training rows only. start: (units: the block's
    different unit starts). doc: (doc_id, held_out, units, starts: the numbers it has and how often).
    """
    kind, own_type = docs.schema["doc_id"].dataType.simpleString(), arrow_type(docs, "doc_id")
    schema = f"kind string, block long, doc_id {kind}, held_out boolean, units binary, starts binary, number long, unit binary, n long"

    def run(batches):
        import pyarrow as pa

        partition, block, size, waiting = TaskContext.get().partitionId(), 0, 0, 0
        numbers: dict[bytes, int] = {}
        learned: list[np.ndarray] = []
        rows: list[tuple] = []
        starts: list[tuple[np.ndarray, np.ndarray]] = []  # per document the keys of its unit starts, and how often it has them

        def nothing():
            return np.empty(0, np.uint64), np.empty((0, 2 * NEAR), np.uint8)

        known, fresh = nothing(), []  # keys, in order, and unit starts of the block; those of its last documents

        def gather():
            nonlocal known, fresh
            keys, own = (np.concatenate(v) for v in zip(known, *fresh))
            keys, first = np.unique(keys, return_index=True)
            known, fresh = (keys, own[first]), []

        types = {
            "doc_id": own_type, "held_out": pa.bool_(), "units": pa.binary(), "starts": pa.binary(), "number": pa.int64(),
            "unit": pa.binary(), "n": pa.int64(),
        }

        def out(name, kind, count, **columns):
            return {"kind": [kind] * count, "block": [name] * count} | {c: columns[c] if c in columns else pa.nulls(count, t) for c, t in types.items()}

        def flush():
            nonlocal numbers, learned, rows, starts, known
            name = partition << 24 | block
            times = np.zeros(len(numbers), np.int64)
            for found in learned:
                np.add.at(times, found[0], found[1])
            units, learned = list(numbers), []
            for begin in range(0, len(units), 50_000):
                part = units[begin : begin + 50_000]
                yield out(name, "unit", len(part), number=np.arange(begin, begin + len(part)), unit=part, n=times[begin : begin + len(part)])
            numbers, units = {}, []
            gather()
            # numbered in their order: by columns they then compress best
            order = np.lexsort(_wide(known[1]).byteswap().T[::-1])
            different, place = known[1][order], np.empty(len(order), np.int64)
            place[order] = np.arange(len(order))
            yield out(name, "start", 1, units=[zlib.compress(different.T.tobytes(), 1)])
            times = np.zeros(len(different), np.int64)
            for at in range(0, len(rows), 10_000):
                part, of = rows[at : at + 10_000], []
                for (_, held_out, _), (keys, many) in zip(part, starts[at : at + 10_000]):
                    own = place[np.searchsorted(known[0], keys)]
                    if not held_out:
                        times[own] += many
                    order = np.argsort(own)
                    of.append(packed(own[order], many[order]))
                ids, held, units_ = map(list, zip(*part))
                yield out(name, "doc", len(part), doc_id=ids, held_out=held, units=units_, starts=of)
            rows, starts = [], []
            known = nothing()
            for at, found in borders_of(different):
                found, of = np.unique(found, return_inverse=True)
                n = np.bincount(of, times[at], len(found)).astype(np.int64)
                found, n = found[n > 0], n[n > 0]
                for begin in range(0, len(found), 50_000):
                    part = pieces_of(found[begin : begin + 50_000])
                    places = np.arange(len(part) + 1, dtype=np.int32) * part.shape[1]
                    pieces = pa.Array.from_buffers(pa.binary(), len(part), [None, pa.py_buffer(places), pa.py_buffer(part.tobytes())])
                    yield out(name, "border", len(part), unit=pieces, n=n[begin : begin + len(part)])

        for batch in batches:
            for doc_id, held_out, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                units = units_of(text.as_py())
                own = np.fromiter([numbers.setdefault(u, len(numbers)) for u in units], np.uint32, len(units))
                distinct, times = np.unique(own, return_counts=True)
                rows.append((doc_id, held_out, packed(distinct, times)))
                own = starts_of(units)
                keys, first, many = np.unique(keys_of(own), return_index=True, return_counts=True)
                starts.append((keys, many.astype(np.uint32)))
                fresh.append((keys, own[first]))
                waiting += len(keys)
                if waiting > STARTED:
                    gather()
                    waiting = 0
                if not held_out:
                    learned.append(np.stack([distinct, times.astype(np.uint32)]))
                size += sum(map(len, units))
                if size > BLOCK_BYTES:
                    yield from flush()
                    block, size, waiting = block + 1, 0, 0
        if rows:
            yield from flush()

    return arrow_map(docs, run, schema)


def _gathered(batches) -> Iterator:
    """Arrow batches of at least ``GATHERED`` rows but for the last one."""
    import pyarrow as pa

    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n >= GATHERED:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held, n = [], 0
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def _learned(units: DataFrame, tables: list[np.ndarray], parts: int, skip: int = 0) -> Model:
    """Mixer and map learned over all units and borders (unit, n), in parts whose sums of fixed size are added up."""
    held = units.sparkSession.sparkContext.broadcast(tables)  # of fixed size

    def run(batches):
        own = Learning()
        for batch in _gathered(batches):
            own.see(held.value, batch.column(0).to_pylist(), batch.column(1).to_numpy(), skip)
        yield {"learned": [own.dump()]}

    # in an order that is the same in a rerun, and not that of the letters
    dealt = units.select("unit", "n").repartition(min(parts * LEARNERS, MOST_PARTS), "unit").sortWithinPartitions(F.xxhash64("unit"), "unit")
    parts_learned = arrow_map(dealt, run, "learned binary").collect()  # MOST_PARTS rows of fixed size at most
    model = Learning.total(row["learned"] for row in parts_learned).model(tables)
    held.destroy()
    return model


def _tables(units: DataFrame, parts: int, skip: int = 0) -> list[np.ndarray]:
    """The predictors' tables, counted in parts and added up by pieces."""
    shape = [1 << size for _, size in CONTEXTS]

    def run(batches):
        tables = [np.zeros((n, 2), np.int32) for n in shape]
        for batch in batches:
            count_tables(batch.column(0).to_pylist(), batch.column(1).to_numpy().astype(np.int32), tables, skip)
        for number, table in enumerate(tables):
            size = min(1 << PART_BITS, len(table))
            for begin in range(0, len(table), size):
                piece = table[begin : begin + size]
                if piece.any():
                    yield {"table": [number], "begin": [begin], "counts": [zlib.compress(piece.tobytes(), 1)]}

    def add(rows: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(zlib.decompress(c), np.int32).astype(np.int64) for c in rows["counts"]).reshape(-1, 2)
        # slots that are seen more often keep the share of ones
        over = np.maximum(total.max(axis=1, keepdims=True) / MOST_SEEN, 1)
        return rows.iloc[:1].assign(counts=[zlib.compress((total / over).astype(np.uint16).tobytes(), 1)])

    # few, large parts keep the number of table copies low; units are different rows, so any of them may meet
    schema = "table int, begin int, counts binary"
    counted = arrow_map(units.select("unit", "n").coalesce(parts), run, schema)
    added = counted.groupBy("table", "begin").applyInPandas(add, schema)
    tables = [np.zeros((n, 2), np.uint16) for n in shape]
    for row in added.toLocalIterator():
        piece = np.frombuffer(zlib.decompress(row["counts"]), np.uint16).reshape(-1, 2)
        tables[row["table"]][row["begin"] : row["begin"] + len(piece)] = piece
    return tables


def score(docs: DataFrame, held_out, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) per row.

    ``held_out`` is a condition; rows where it holds (or is null) are scored but not learned
    from. A null text is empty: one end token. Scores are log10 probabilities:
    ``base_score`` of the words under add-half counts, ``score`` of the whole lower-cased
    text under the mixed model. Rows that repeat an id count as rows of their own; other columns are not read. Without
    training rows every word is unknown and the predictors are empty.
    """
    rows = docs.select(
        docs[id_column].alias("doc_id"),
        F.coalesce(held_out, F.lit(True)).alias("held_out"),
        text_or_empty(text_column).alias("text"),
    )
    held = written(_blocks(rows), "mixing-blocks", partition_by="kind")
    placed = held.where("kind = 'unit'").select("block", "number", "unit", "n")
    word = F.expr("substring(unit, 1, length(unit) - 1)")
    # dealt by word once: units of a word lie together too
    units = placed.select(word.alias("word"), "unit", "n").repartition("word").groupBy("word", "unit").agg(F.sum("n").alias("n"))
    # a word's units: one per white space sign
    words = units.groupBy("word").agg(F.sum("n").alias("c"), F.collect_list(F.struct("unit", "n")).alias("units"))
    units = written(words.select("c", F.explode("units").alias("u")).select("u.unit", "u.n", "c"), "mixing-units")
    learned = units.where("n > 0")
    word_rows = learned.where("length(unit) > 1")
    row = learned.agg(
        F.sum(F.when(F.expr("length(unit) > 1"), F.col("n")).otherwise(0)).alias("words"),
        F.sum(F.when(F.expr("substring(unit, -1, 1) = X'FF'"), F.col("n")).otherwise(0)).alias("ends"),
        F.count("*").alias("units"),
    ).first()
    distinct = word_rows.agg(F.count_distinct(word).alias("v")).first()["v"]
    ends = row["ends"] or 0
    train_tokens = (row["words"] or 0) + ends
    size = distinct + (1 if ends else 0)
    borders = held.where("kind = 'border'").groupBy("unit").agg(F.sum("n").alias("n"))
    learned = learned.select("unit", "n").unionByName(written(borders, "mixing-borders"))
    parts = int(min(MOST_PARTS, max(1, -(-row["units"] // UNITS_PER_PART))))
    model = docs.sparkSession.sparkContext.broadcast(_learned(learned, _tables(learned, parts, NEAR), parts, NEAR))  # of fixed size

    def grade(batches):
        for batch in _gathered(batches):
            found = batch.column(0).to_pylist()
            yield {"unit": batch.column(0), "c": batch.column(1), "p": model.value.unit_scores(found, NEAR)}

    graded = arrow_map(units.select("unit", "c"), grade, "unit binary, c long, p double")
    known = placed.select("block", "number", "unit").join(graded, "unit").select(
        "block", "number", "c", "p", (F.expr("length(unit) > 1")).alias("is_word"), F.expr("substring(unit, -1, 1) = X'FF'").alias("is_end")
    )
    documents = held.where("kind in ('doc', 'start')").select(F.col("block").alias("of_block"), "kind", "doc_id", "held_out", "units", "starts")
    kind = rows.schema["doc_id"].dataType.simpleString()
    log_all = np.log10(train_tokens + 0.5 * (size + 1))

    def add_up(texts: pd.DataFrame, found: pd.DataFrame) -> pd.DataFrame:
        at = found["number"].to_numpy()
        p, tokens, seen, base = (np.zeros(len(found)) for _ in range(4))
        is_word, is_end, c = (found[k].to_numpy() for k in ("is_word", "is_end", "c"))
        p[at] = found["p"]
        tokens[at] = is_word.astype(int) + is_end
        seen[at] = (is_word & (c > 0)).astype(int) + (is_end & (ends > 0))
        base[at] = is_word * (np.log10(c + 0.5) - log_all) + is_end * (np.log10(ends + 0.5) - log_all)
        is_start, out = texts["kind"] == "start", []
        [starts] = texts.loc[is_start, "units"]
        starts, texts = np.frombuffer(zlib.decompress(starts), np.uint8).reshape(2 * NEAR, -1).T, texts[~is_start]
        begun = np.concatenate([model.value.start_scores(starts[at : at + STARTED]) for at in range(0, len(starts), STARTED)])
        for row in texts.itertuples(index=False):
            own, times = unpacked(row.units)
            sums = [(x[own] * times).sum() for x in (tokens, seen, base, p)]
            own, times = unpacked(row.starts)
            out.append([*sums[:3], sums[3] + (begun[own] * times).sum()])
        n_tokens, n_known, base_score, total = np.array(out, float).reshape(-1, 4).T
        return pd.DataFrame(
            {
                "doc_id": texts["doc_id"],
                "held_out": texts["held_out"],
                "n_tokens": n_tokens.astype(np.int64),
                "n_known": n_known.astype(np.int64),
                "train_tokens": np.int64(train_tokens),
                "base_score": base_score,
                "score": total,
            }
        )

    return (
        documents.groupBy("of_block")
        .cogroup(known.groupBy("block"))
        .applyInPandas(
            add_up,
            f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double",
        )
    )
