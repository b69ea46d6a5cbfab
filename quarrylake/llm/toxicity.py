"""Toxicity of texts: a bidirectional gated recurrent network with attention pooling.

Each word enters as a hashed word vector and the sum of its hashed character n-gram
vectors. Two gated recurrent layers, one per direction, read a window of words, attention
pools their states, and a logistic unit gives the window's score. All windows of a text,
overlapping by half, are scored; the highest one and the number of windows give the
probability of the text. The network is trained in numpy by back-propagation through time.

Labels belong to whole texts. So training goes in rounds: first every window of a short
text carries its label, then a toxic text lends its label to the windows that the network
finds worst, while all windows of clean texts stay clean.

The fit takes a bounded sample of labelled rows (``SAMPLE_PER_LABEL`` of each label).
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarrylake.llm.common import arrow_filter, arrow_map, joined, text_or_empty, words_of

#: Bound of the labelled rows that each label gives to the fit.
SAMPLE_PER_LABEL = 1500
WINDOW, STRIDE = 32, 16
HIDDEN, ATTENTION = 8, 8
WORD_BITS, WORD_SIZE = 17, 8
#: A word has a vector of its own if so many texts of the sample hold it; others are read by their characters.
WORD_TEXTS = 3
#: Every fifth text of the sample is kept back for the calibration.
KEPT_BACK = 5
CHAR_BITS, CHAR_SIZE = 15, 12
CHAR_ORDERS = (3, 4, 5, 6)
LONGEST_WORD = 24
#: Words whose n-grams are looked up in one go.
LOOKED_UP = 1024
ROUNDS, EPOCHS, BATCH, RATE = 5, 3, 256, 0.01
#: Clean windows of a round besides the worst ones, at least (all, if there are fewer).
OTHERS = 1000
#: Share of a word's inputs that are left out at random while training.
DROPOUT = 0.3


@dataclass
class Network:
    p: dict[str, np.ndarray]
    slope: np.ndarray = field(default_factory=lambda: np.array([1.0, 0.0, 0.0]))  # of highest logit, log windows, 1


def fresh(seed: int = 5) -> Network:
    r = np.random.default_rng(seed)
    size = WORD_SIZE + CHAR_SIZE
    shape = {
        "word": ((1 << WORD_BITS, WORD_SIZE), 0.1),
        "char": ((1 << CHAR_BITS, CHAR_SIZE), 0.1),
        "wf": ((size, 3 * HIDDEN), size**-0.5),
        "wb": ((size, 3 * HIDDEN), size**-0.5),
        "uf": ((HIDDEN, 3 * HIDDEN), HIDDEN**-0.5),
        "ub": ((HIDDEN, 3 * HIDDEN), HIDDEN**-0.5),
        "cf": ((3 * HIDDEN,), 0),
        "cb": ((3 * HIDDEN,), 0),
        "wa": ((2 * HIDDEN, ATTENTION), 0.25),
        "ba": ((ATTENTION,), 0),
        "va": ((ATTENTION,), 0.3),
        "wo": ((2 * HIDDEN,), 0.25),
        "bo": ((1,), 0),
    }
    return Network({k: (r.standard_normal(s) * scale).astype(np.float32) for k, (s, scale) in shape.items()})


def char_grams(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, longest: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the character n-grams of each word, with marks at both ends: a matrix, padded for words of ``longest`` bytes, and its mask."""
    lengths = ends - starts
    width = (longest or int(lengths.max())) + 2
    place = np.arange(width)
    letters = raw[np.minimum(starts[:, None] + np.maximum(place - 1, 0), len(raw) - 1)].astype(np.uint32) | np.uint32(32)
    letters[:, 0] = 1
    letters = np.where(place[None] == lengths[:, None] + 1, np.uint32(2), letters)
    used = place[None] < lengths[:, None] + 2
    out, real = [], []
    total = np.zeros((len(starts), width), np.uint32)
    for order in range(1, max(CHAR_ORDERS) + 1):
        if order > width:
            break
        total = total[:, : width - order + 1] * np.uint32(0x01000193) + letters[:, order - 1 :] * np.uint32(0x85EBCA6B)
        if order in CHAR_ORDERS:
            h = (total ^ (total >> np.uint32(15))) * np.uint32(0x9E3779B1)
            out.append(((h ^ (h >> np.uint32(13))) >> np.uint32(32 - CHAR_BITS)).astype(np.uint16))
            real.append(used[:, order - 1 :])
    return np.concatenate(out, axis=1), np.concatenate(real, axis=1)


def word_inputs(p: dict, numbers: np.ndarray, grams: np.ndarray, real: np.ndarray) -> np.ndarray:
    out = np.empty((len(numbers), WORD_SIZE + CHAR_SIZE), np.float32)
    out[:, :WORD_SIZE] = p["word"][numbers >> np.uint64(64 - WORD_BITS)]
    # a piece at a time, as each n-gram of each word has a vector
    for some in _pieces(len(numbers)):
        present = real[some]
        out[some, WORD_SIZE:] = (p["char"][grams[some]] * present[:, :, None]).sum(axis=1) / np.sqrt(np.maximum(present.sum(axis=1), 1))[:, None]
    return out


def _pieces(count: int) -> list[slice]:
    return [slice(at, at + LOOKED_UP) for at in range(0, count, LOOKED_UP)]


def window_starts(words: int) -> np.ndarray:
    """Starts of windows that cover all words, each half over the one before; the last one ends with the text."""
    if words <= WINDOW:
        return np.zeros(1, np.int64)
    return np.append(np.arange(0, words - WINDOW, STRIDE), words - WINDOW)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


def _gru(x: np.ndarray, u: np.ndarray, keep: list | None = None) -> np.ndarray:
    """States of a gated recurrent layer over x (steps x rows x 3 hidden), already projected."""
    h = np.zeros((x.shape[1], HIDDEN), np.float32)
    out = np.empty((*x.shape[:2], HIDDEN), np.float32)
    for t in range(len(x)):
        g = h @ u
        gates = _sigmoid(x[t, :, : 2 * HIDDEN] + g[:, : 2 * HIDDEN])
        z, r = gates[:, :HIDDEN], gates[:, HIDDEN:]
        n = np.tanh(x[t, :, 2 * HIDDEN :] + r * g[:, 2 * HIDDEN :])
        if keep is not None:
            keep.append((z, r, n, g[:, 2 * HIDDEN :], h))
        h = n + z * (h - n)
        out[t] = h
    return out


def _gru_back(dh_out: np.ndarray, u: np.ndarray, keep: list) -> tuple[np.ndarray, np.ndarray]:
    dx, du = np.empty((*dh_out.shape[:2], 3 * HIDDEN), np.float32), np.zeros_like(u)
    dh = np.zeros(dh_out.shape[1:], np.float32)
    for t in range(len(dh_out) - 1, -1, -1):
        z, r, n, g, before = keep[t]
        dh = dh + dh_out[t]
        dn = dh * (1 - z) * (1 - n * n)
        dz = dh * (before - n) * z * (1 - z)
        dr = dn * g * r * (1 - r)
        dx[t] = np.concatenate([dz, dr, dn], axis=1)
        dg = np.concatenate([dz, dr, dn * r], axis=1)
        du += before.T @ dg
        dh = dh * z + dg @ u.T
    return dx, du


def _attend(p: dict, states: np.ndarray, mask: np.ndarray):
    """Pooled states and what led to them; states: steps x rows x 2 hidden, mask: steps x rows."""
    a = np.tanh(states @ p["wa"] + p["ba"])
    s = np.where(mask, a @ p["va"], np.float32(-1e9))
    s = np.exp(s - s.max(axis=0))
    s /= s.sum(axis=0)
    return (states * s[:, :, None]).sum(axis=0), a, s


def window_logits(p: dict, xf: np.ndarray, xb: np.ndarray, mask: np.ndarray) -> np.ndarray:
    states = np.concatenate([_gru(xf, p["uf"]), _gru(xb[::-1], p["ub"])[::-1]], axis=2)
    return _attend(p, states, mask)[0] @ p["wo"] + p["bo"]


@dataclass
class Words:
    """The words of some texts: each distinct one once, and windows of places in that list."""

    numbers: np.ndarray
    grams: np.ndarray
    real: np.ndarray
    windows: np.ndarray  # rows x WINDOW, -1 beyond the end
    text: np.ndarray  # of each window
    texts: np.ndarray  # with each distinct word


def prepared(texts: list[str]) -> Words:
    numbers, grams, owners, words = [], [], [], []
    for at, text in enumerate(texts):
        raw = text.encode("utf-8", "replace")
        found, starts, ends = words_of(raw, LONGEST_WORD)
        words.append(found)
        owners.append(at)
        if len(found):
            distinct, first = np.unique(found, return_index=True)
            numbers.append(distinct)
            grams.append([raw[s:e] for s, e in zip(starts[first], ends[first])])
    if not numbers:
        distinct, spelled = np.empty(0, np.uint64), []
    else:
        distinct, first = np.unique(np.concatenate(numbers), return_index=True)
        everything = [g for part in grams for g in part]
        spelled = [everything[i] for i in first]
    raw = np.frombuffer(b"".join(spelled) or b" ", np.uint8)
    ends = np.cumsum([len(s) for s in spelled] or [1])
    starts = np.concatenate([[0], ends[:-1]])
    longest = int((ends - starts).max())
    matrix, real = (np.concatenate(m) for m in zip(*(char_grams(raw, starts[some], ends[some], longest) for some in _pieces(len(starts)))))
    rows, text = [], []
    for at, found in enumerate(words):
        places = np.full(max(len(found), WINDOW), -1, np.int32)
        places[: len(found)] = np.searchsorted(distinct, found)
        begins = window_starts(len(found))
        rows.append(places[begins[:, None] + np.arange(WINDOW)])
        text.append(np.full(len(begins), at))
    holders = np.bincount(np.searchsorted(distinct, np.concatenate(numbers)), minlength=len(distinct)) if numbers else np.zeros(1)
    numbers = distinct if len(distinct) else np.zeros(1, np.uint64)
    return Words(numbers, matrix, real, np.concatenate(rows), np.concatenate(text), holders)


def _projected(p: dict, words: Words, windows: np.ndarray):
    used, places = np.unique(windows, return_inverse=True)
    places = places.reshape(windows.shape)
    lone = np.maximum(used, 0)
    x = word_inputs(p, words.numbers[lone], words.grams[lone], words.real[lone])
    x[used < 0] = 0
    return used, places, x


def logits_of(p: dict, words: Words) -> np.ndarray:
    out = []
    for at in range(0, len(words.windows), 2048):
        windows = words.windows[at : at + 2048]
        _, places, x = _projected(p, words, windows)
        turned = places.T
        out.append(window_logits(p, (x @ p["wf"] + p["cf"])[turned], (x @ p["wb"] + p["cb"])[turned], windows.T >= 0))
    return np.concatenate(out)


def gradients(
    p: dict, words: Words, windows: np.ndarray, labels: np.ndarray, weight: np.ndarray, r: np.random.Generator | None = None
) -> dict:
    """Gradients of the weighted logistic loss of the windows; with ``r``, inputs are dropped at random."""
    used, places, x = _projected(p, words, windows)
    share = np.ones_like(x) if r is None else ((r.random(x.shape) >= DROPOUT) / (1 - DROPOUT)).astype(np.float32)
    x = x * share
    turned, mask = places.T, windows.T >= 0
    kept: tuple[list, list] = ([], [])
    xf, xb = (x @ p["wf"] + p["cf"])[turned], (x @ p["wb"] + p["cb"])[turned][::-1]
    states = np.concatenate([_gru(xf, p["uf"], kept[0]), _gru(xb, p["ub"], kept[1])[::-1]], axis=2)
    pooled, a, s = _attend(p, states, mask)
    error = ((_sigmoid(pooled @ p["wo"] + p["bo"]) - labels) * weight / weight.sum()).astype(np.float32)
    d = {"wo": pooled.T @ error, "bo": error.sum(keepdims=True)}
    dpooled = error[:, None] * p["wo"]
    dweights = (states * dpooled).sum(axis=2)
    ds = s * (dweights - (s * dweights).sum(axis=0))
    dpre = ds[:, :, None] * p["va"] * (1 - a * a)
    d["va"] = (a * ds[:, :, None]).sum(axis=(0, 1))
    d["ba"] = dpre.sum(axis=(0, 1))
    d["wa"] = np.einsum("tnh,tna->ha", states, dpre)
    dstates = s[:, :, None] * dpooled + dpre @ p["wa"].T
    dxf, d["uf"] = _gru_back(dstates[:, :, :HIDDEN], p["uf"], kept[0])
    dxb, d["ub"] = _gru_back(dstates[::-1, :, HIDDEN:], p["ub"], kept[1])
    dx = np.zeros_like(x)
    for name, bias, part in (("wf", "cf", dxf), ("wb", "cb", dxb[::-1])):
        into = np.zeros((len(x), 3 * HIDDEN), np.float32)
        np.add.at(into, turned.ravel(), part.reshape(-1, 3 * HIDDEN))
        d[bias] = into.sum(axis=0)
        d[name] = x.T @ into
        dx += into @ p[name].T
    dx *= share
    real = used >= 0
    lone = used[real]
    d["word"], d["char"] = np.zeros_like(p["word"]), np.zeros_like(p["char"])
    np.add.at(d["word"], words.numbers[lone] >> np.uint64(64 - WORD_BITS), dx[real, :WORD_SIZE])
    of_chars = dx[real, WORD_SIZE:]
    for some in _pieces(len(lone)):  # in the same order as in one go, so sums are equal bit by bit
        grams, present = words.grams[lone[some]], words.real[lone[some]]
        of_gram = of_chars[some] / np.sqrt(np.maximum(present.sum(axis=1), 1))[:, None]
        row, column = np.nonzero(present)
        np.add.at(d["char"], grams[row, column], of_gram[row])
    return d


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Slopes of a small logistic regression, by Newton steps with a little ridge."""
    slope = np.zeros(x.shape[1])
    for _ in range(30):
        mean = _sigmoid(np.clip(x @ slope, -30, 30))
        spread = (weight * mean * (1 - mean))[:, None] * x
        slope += np.linalg.solve(x.T @ spread + 1e-3 * np.eye(x.shape[1]), x.T @ (weight * (y - mean)) - 1e-3 * slope)
    return slope


def _highest(logits: np.ndarray, text: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """Highest logit of each text and its number of windows."""
    most = np.full(count, -np.inf)
    np.maximum.at(most, text, logits)
    return most, np.bincount(text, minlength=count)


def train(texts: list[str], labels: list[int], clean_share: float = 0.5, seed: int = 5) -> Network:
    """The network fitted to texts with labels 0 and 1.

    ``clean_share``: how many labelled texts at large are clean, for the calibration.
    """
    network, r = fresh(seed), np.random.default_rng(seed)
    p, y = network.p, np.array(labels, np.float32)
    words = prepared(texts)
    count = np.bincount(words.text, minlength=len(texts))
    named = np.zeros(1 << WORD_BITS, bool)
    named[words.numbers[words.texts >= WORD_TEXTS] >> np.uint64(64 - WORD_BITS)] = True
    p["word"][~named] = 0
    kept = np.arange(len(texts)) % KEPT_BACK == 0
    if min((y[kept] == label).sum() for label in (0, 1)) < 10:
        kept[:] = False
    learned = ~kept[words.text]
    momentum = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in p.items()}
    step = 0
    for turn in range(ROUNDS):
        if turn == 0:
            near = count[words.text] <= max(4, np.quantile(count, 0.3))
            positive = np.flatnonzero(learned & near & (y[words.text] == 1))
            negative = np.flatnonzero(learned & near & (y[words.text] == 0))
        else:
            logits = logits_of(p, words)
            order = np.lexsort((-logits, words.text))
            first = np.concatenate([[0], np.cumsum(count)[:-1]])
            rank = np.empty(len(order), np.int64)
            rank[order] = np.arange(len(order)) - np.repeat(first, count)
            positive = np.flatnonzero(learned & (y[words.text] == 1) & (rank < 2))
            clean = learned & (y[words.text] == 0)
            negative = np.flatnonzero(clean & (rank < 2))
            others = np.flatnonzero(clean & (rank >= 2))
            negative = np.concatenate([negative, r.permutation(others)[: max(len(negative), OTHERS)]])
        if not len(positive) or not len(negative):
            break
        chosen = np.concatenate([positive, negative])
        weight = np.concatenate([np.full(len(positive), 1 / len(positive)), np.full(len(negative), 1 / len(negative))])
        for _ in range(EPOCHS):
            mixed_order = r.permutation(len(chosen))
            for at in range(0, len(chosen), BATCH):
                part = mixed_order[at : at + BATCH]
                rows = chosen[part]
                d = gradients(p, words, words.windows[rows], y[words.text[rows]], weight[part], r)
                d["word"][~named] = 0
                step += 1
                for k, g in d.items():
                    m, v = momentum[k]
                    m += 0.1 * (g - m)
                    v += 0.001 * (g * g - v)
                    p[k] -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    most, windows = _highest(logits_of(p, words), words.text, len(texts))
    if len(set(labels)) == 2:
        own = kept if kept.any() else ~kept
        most, windows, y = most[own], windows[own], y[own]
        toxic = float(y.mean())
        weight = np.where(y == 1, (1 - clean_share) / toxic, clean_share / (1 - toxic))
        network.slope = _logistic(np.column_stack([most, np.log(windows), np.ones(len(most))]), y, weight)
    else:
        network.slope = np.array([0.0, 0.0, 6.0 if labels and labels[0] == 1 else -6.0])
    return network


class Scorer:
    """Scores of texts; the projected inputs of words seen lately are kept in a table of fixed size."""

    SLOTS = 1 << 17

    def __init__(self, network: Network):
        self.p, self.slope = network.p, network.slope
        both = np.concatenate([self.p["wf"], self.p["wb"]], axis=1)
        self.both, self.bias = both, np.concatenate([self.p["cf"], self.p["cb"]])
        self.keys = np.zeros(self.SLOTS, np.uint64)
        self.rows = np.zeros((self.SLOTS, 6 * HIDDEN), np.float32)

    def inputs(self, raw: bytes, numbers: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Projected input of each word."""
        slot = (numbers & np.uint64(self.SLOTS - 1)).astype(np.int64)
        missing = np.flatnonzero(self.keys[slot] != numbers)
        if len(missing):
            new, first = np.unique(numbers[missing], return_index=True)
            at, letters = missing[first], np.frombuffer(raw, np.uint8)
            for part in range(0, len(new), 8192):
                some = at[part : part + 8192]
                grams, real = char_grams(letters, starts[some], ends[some])
                self.keys[slot[some]] = numbers[some]
                self.rows[slot[some]] = word_inputs(self.p, numbers[some], grams, real) @ self.both + self.bias
        out = self.rows[slot]
        lost = np.flatnonzero(self.keys[slot] != numbers)  # two words of this text on one slot
        for part in range(0, len(lost), 8192):
            some = lost[part : part + 8192]
            grams, real = char_grams(np.frombuffer(raw, np.uint8), starts[some], ends[some])
            out[some] = word_inputs(self.p, numbers[some], grams, real) @ self.both + self.bias
        return out

    def scores(self, texts: list[str | None]) -> np.ndarray:
        return np.concatenate([self._scores(*part) for part in joined(texts)]) if texts else np.empty(0)

    def _scores(self, raw: bytes, places: np.ndarray) -> np.ndarray:
        numbers, starts, ends = words_of(raw, LONGEST_WORD)
        count = np.diff(np.searchsorted(starts, places))
        first = np.cumsum(count) - count
        x = np.concatenate([self.inputs(raw, numbers, starts, ends), self.bias[None]])  # the last row: no word
        begins = [window_starts(int(n)) + f for n, f in zip(count, first)]
        text = np.repeat(np.arange(len(count)), [len(b) for b in begins])
        begins = np.concatenate(begins)
        stop = (first + count)[text]
        logits = np.empty(len(begins))
        for at in range(0, len(begins), 2048):
            window = begins[at : at + 2048] + np.arange(WINDOW)[:, None]
            mask = window < stop[at : at + 2048]
            rows = x[np.where(mask, window, len(numbers))]
            logits[at : at + 2048] = window_logits(self.p, rows[:, :, : 3 * HIDDEN], rows[:, :, 3 * HIDDEN :], mask)
        most, windows = _highest(logits, text, len(count))
        return _sigmoid(np.clip(np.column_stack([most, np.log(windows), np.ones(len(most))]) @ self.slope, -30, 30))


def fit(docs: DataFrame, labels: DataFrame, sample_per_label: int = SAMPLE_PER_LABEL) -> Network | None:
    """The network fitted to the documents that ``labels`` (doc_id, toxic 0/1) marks; None without labels.

    About ``sample_per_label`` documents of each label are taken (all, if fewer), by a
    hash of their id. Labels that are null or neither 0 nor 1 are left out; of several labels of an id the
    highest counts, and of several texts of an id the greatest.
    """
    marked = (
        labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull())
        .groupBy("doc_id")
        .agg(F.max("toxic").cast("int").alias("toxic"))
    )
    counts = {r["toxic"]: r["n"] for r in marked.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return None
    share = F.create_map(*[F.lit(v) for label, n in counts.items() for v in (label, min(1.0, sample_per_label / n))])
    chance = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) / F.lit(float(1 << 20))
    sample = F.broadcast(marked.where(chance < share[F.col("toxic")]))  # about sample_per_label rows of each label
    rows = (
        docs.select("doc_id", text_or_empty("text").alias("text"))
        .join(sample, "doc_id")
        .groupBy("doc_id", "toxic")
        .agg(F.max("text").alias("text"))
        .collect()
    )
    if not rows:
        return None
    rows = sorted((str(r["doc_id"]), r["text"], r["toxic"]) for r in rows)
    return train([r[1] for r in rows], [r[2] for r in rows], counts.get(0, 0) / sum(counts.values()))


def score(docs: DataFrame, network: Network | None, id_column: str = "doc_id", text_column: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """(the id, score) per row, with the columns of ``keep``; 0.0 everywhere without a network.

    A null or empty text has one window without words. Other columns are not read.
    """
    held = docs.sparkSession.sparkContext.broadcast(network)  # of fixed size
    kinds = dict(docs.dtypes)

    def run(batches):
        scorer = Scorer(held.value) if held.value else None
        for batch in batches:
            texts = batch.column(1).to_pylist()
            found = scorer.scores(texts) if scorer else np.zeros(len(texts))
            yield {"doc_id": batch.column(0), **{k: batch.column(k) for k in keep}, "score": found}

    rows = docs.select(docs[id_column].alias("doc_id"), docs[text_column].cast("string").alias("scored text"), *keep)
    columns = [f"doc_id {kinds[id_column]}", *[f"`{k}` {kinds[k]}" for k in keep], "score double"]
    return arrow_map(rows, run, ", ".join(columns))


def accepted(docs: DataFrame, network: Network | None, threshold: float = 0.5, text_column: str = "text") -> DataFrame:
    """The rows whose score is below the threshold, with all their columns; all rows without a network."""
    held = docs.sparkSession.sparkContext.broadcast(network)  # of fixed size

    def keeper():
        scorer = Scorer(held.value) if held.value else None
        return lambda texts: (scorer.scores(texts) < threshold if scorer else np.ones(len(texts), bool)).tolist()

    return arrow_filter(docs, text_column, keeper)
