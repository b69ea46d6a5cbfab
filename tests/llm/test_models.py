import collections
import math
import re
import tracemalloc
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarrylake.llm import langid, mixing, toxicity
from quarrylake.llm.common import fold


def texts_of(text, marks, count, seed=0):
    return [f"{text(seed + i, 30)} {marks[i % len(marks)]} {text(seed + 500 + i, 25)}" for i in range(count)]


@pytest.fixture(scope="module")
def network(text):
    toxic, clean = texts_of(text, ["scumbag", "vileword"], 120), [text(3000 + i, 60) for i in range(120)]
    return toxicity.train(toxic + clean, [1] * 120 + [0] * 120)


def test_network_finds_marked_texts(network, text):
    scorer = toxicity.Scorer(network)
    bad = scorer.scores(texts_of(text, ["scumbag", "vileword"], 60, seed=9000))
    good = scorer.scores([text(8000 + i, 60) for i in range(60)])
    assert (bad >= 0.5).mean() > 0.9 and (good < 0.5).mean() > 0.9


def test_gradients_agree_with_differences(text):
    words = toxicity.prepared([text(1, 40), text(2, 10)])
    p = {k: v.astype(np.float64) for k, v in toxicity.fresh().p.items()}
    y, weight = np.array([1.0, 0.0, 1.0])[: len(words.windows)], np.ones(len(words.windows))

    def loss():
        z = toxicity.logits_of(p, words)
        return float((np.logaddexp(0, z) - y * z).mean())

    d = toxicity.gradients(p, words, words.windows, y, weight)
    for name in ("wf", "ub", "cf", "wa", "va", "wo", "char"):
        at = np.unravel_index(np.abs(d[name]).argmax(), d[name].shape)
        step = 1e-2
        p[name][at] += step
        up = loss()
        p[name][at] -= 2 * step
        down = loss()
        p[name][at] += step
        assert abs((up - down) / (2 * step) - d[name][at]) < 0.05 * abs(d[name][at]) + 1e-4


def test_scores_cover_odd_texts_and_do_not_depend_on_batches(spark, documents, odd, network):
    scorer = toxicity.Scorer(network)
    whole = scorer.scores([t for _, t in odd])
    alone = np.concatenate([toxicity.Scorer(network).scores([t]) for _, t in odd])
    assert np.allclose(whole, alone, atol=1e-5) and ((whole >= 0) & (whole <= 1)).all()
    got = toxicity.score(documents(*odd), network)
    assert got.columns == ["doc_id", "score"] and got.count() == len(odd)
    assert toxicity.score(documents(), network).count() == 0
    assert toxicity.accepted(documents(*odd), network).columns == documents().columns
    assert toxicity.accepted(documents(*odd), None).count() == len(odd)


def test_windows_cover_all_words():
    for words in (0, 1, 32, 33, 48, 49, 1000):
        starts = toxicity.window_starts(words)
        seen = {w for s in starts for w in range(s, s + toxicity.WINDOW)}
        assert set(range(words)) <= seen and starts[-1] == max(0, words - toxicity.WINDOW)


def test_fit_without_or_with_one_label(spark, documents, text):
    docs = documents((1, text(1, 20)), (2, text(2, 20)), (None, "x"))
    schema = "doc_id bigint, quality int, toxic int"
    assert toxicity.fit(docs, spark.createDataFrame([], schema)) is None
    assert toxicity.fit(docs, spark.createDataFrame([(1, 1, None), (None, 1, 1), (7, 1, 1)], schema)) is None
    one = toxicity.fit(docs, spark.createDataFrame([(1, 1, 0), (1, 0, 0), (2, None, 0)], schema))
    assert toxicity.accepted(docs, one).count() == 3


def test_language_id(spark, documents, odd):
    words = {"aa": "the and of with this that", "bb": "der und nicht mit auch eine", "cc": "que los para una como más"}
    rows, i = [], 1000
    for lang, pool in words.items():
        for k in range(40):
            i += 1
            own = pool.split()
            rows.append((i, " ".join(own[(k * j) % 6] for j in range(3, 15)), lang))
    train = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    model = langid.fit(train.unionByName(spark.createDataFrame([(1, None, "aa"), (2, "x", None), (3, "..", "bb")], train.schema)))
    assert model.languages == ["aa", "bb", "cc"] and (model.weights == 0).mean() > 0.9
    got = {r.doc_id: r for r in langid.predict(train, model).collect()}
    assert np.mean([got[i].lang_pred == lang for i, _, lang in rows]) > 0.98
    rest = langid.predict(documents(*odd), model).collect()
    und = {r.doc_id for r in rest if r.lang_pred == "und"}
    assert und == {1, 2, 4, 5} and all(0 <= r.score <= 1 for r in rest) and len(rest) == len(odd)
    assert langid.fit(train.where("false")) is None and langid.predict(documents((1, "x")), None).first().lang_pred == "und"
    assert langid.predict(documents(), model).count() == 0


def base(rows, training):
    tokens = {k: [*re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode().lower()), None] for k, (_, t) in enumerate(rows)}
    count = collections.Counter(w for k in training for w in tokens[k])
    total, size = sum(count.values()), len(count)
    return [
        (len(w), sum(count[x] > 0 for x in w), total, sum(math.log10((count[x] + 0.5) / (total + 0.5 * (size + 1))) for x in w))
        for w in tokens.values()
    ]


def test_language_model_scores(spark, documents, odd, text):
    rows = [*odd, *[(100 + i, f"{text(i, 50)}\n\n{text(3, 40)}\t ") for i in range(40)]]
    got = mixing.score(documents(*rows), fold("doc_id", 5) == 1).collect()
    training = [k for k, (i, _) in enumerate(rows) if zlib.crc32(("" if i is None else str(i)).encode()) % 5 != 1]
    expected = sorted((str(i), *b[:3], round(b[3], 6)) for (i, _), b in zip(rows, base(rows, training)))
    assert sorted((str(r.doc_id), r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == expected
    assert all(r.score < 0 for r in got)
    none = mixing.score(documents(*odd), F.lit(True)).collect()
    assert {r.train_tokens for r in none} == {0} and {r.n_known for r in none} == {0}
    assert mixing.score(documents(), F.lit(False)).count() == 0


def test_unit_probabilities_add_up_to_one_at_most(text):
    units = [u for i in range(40) for u in mixing.units_of(text(i, 50))]
    assert b"".join(mixing.units_of("A b\n\nc ")) == b"a b\n\nc \xff"
    many = collections.Counter(units)
    tables = [np.zeros((1 << bits, 2), np.int32) for _, bits in mixing.CONTEXTS]
    mixing.count_tables(list(many), np.array(list(many.values()), np.int32), tables)
    model = mixing.train(tables, list(many.items()))
    every = [bytes([a]) for a in range(256)]
    assert abs((10 ** model.unit_scores(every)).sum() - 1) < 1e-6  # the first byte, over all its values
    after = [b"k" + bytes([a]) for a in range(256)]
    assert abs((10 ** (model.unit_scores(after) - model.unit_scores([b"k"]))).sum() - 1) < 1e-6
    seen, unseen = model.unit_scores([units[0]])[0], model.unit_scores([b"zzqxj "])[0]
    assert seen > unseen


def test_score_sees_what_is_before_a_unit(spark, documents, text):
    rows = [(i, "the cat sat on the mat and the dog lay by the door " * 3 + text(i, 40)) for i in range(60)]
    there = "the cat sat on the mat and the dog lay by the door"
    shuffled = " ".join(sorted(there.split(), key=lambda w: w[::-1]))
    rows += [(100, f"{there} "), (101, f"{shuffled} ")]
    got = {r.doc_id: r for r in mixing.score(documents(*rows), F.col("doc_id") >= 100).collect()}
    assert round(got[100].base_score, 9) == round(got[101].base_score, 9) and got[100].n_tokens == got[101].n_tokens
    assert got[100].score > got[101].score + 1


def test_units_and_borders_score_every_byte_of_a_text_once(text):
    texts = [f"a b\n\nc {text(i, 30)} {'long' * 9}{i} \t" for i in range(20)] + ["", "é", "x" * 12]
    many, starts = collections.Counter(u for t in texts for u in mixing.units_of(t)), np.concatenate([mixing.starts_of(mixing.units_of(t)) for t in texts])
    assert all(np.array_equal(a, b) for a, b in zip(mixing.unpacked(mixing.packed(np.array([3, 7, 500_000]), np.array([1, 70_000, 2]))), ([3, 7, 500_000], [1, 70_000, 2])))
    borders = [p.tobytes() for _, found in mixing.borders_of(starts) for p in mixing.pieces_of(found)]
    assert len(borders) + sum(n * max(len(u) - mixing.NEAR, 0) for u, n in many.items()) == sum(len(t.encode()) + 1 for t in texts)
    tables = [np.zeros((1 << bits, 2), np.int32) for _, bits in mixing.CONTEXTS]
    mixing.count_tables([*many, *borders], np.array([*many.values(), *[1] * len(borders)], np.int32), tables, mixing.NEAR)
    model = mixing.Learning().model(tables)
    for t in texts:
        units = mixing.units_of(t)
        fast = model.unit_scores(units, mixing.NEAR).sum() + model.start_scores(mixing.starts_of(units)).sum()
        slow, chain, begin = 0.0, bytes([mixing.BLANK]) * 5 + b"".join(units), 5
        for unit in units:  # each byte alone, after its contexts
            for at, byte in enumerate(unit):
                x = chain[: begin + at + 1]
                contexts = [x[-1 - n : -1] if n else unit[:at] for n, _ in mixing.CONTEXTS]
                slow += byte_score(model, byte, contexts)
            begin += len(unit)
        assert abs(fast - slow) < 1e-6


def byte_score(model, byte, contexts):
    total, powers = 0.0, mixing._power_tables(64)[0]
    for at in range(8):
        partial, bit, counts, inputs = (1 << at) | byte >> (8 - at), byte >> (7 - at) & 1, [], []
        for k, ((length, size), context) in enumerate(zip(mixing.CONTEXTS, contexts)):
            number = np.zeros(1, np.uint64)
            if length is None:
                number += (mixing._BYTES[list(context)] * powers[: len(context)]).sum(dtype=np.uint64) + np.uint64(7)
            else:
                for c in reversed(context):
                    number = number * np.uint64(0x9E3779B97F4A7C15) + mixing._BYTES[c]
                number += np.uint64(length)
            slot = (mixing.mixed(number) + np.full(1, partial, np.uint64) * np.uint64(0xD6E8FEB86659FD93)) * np.uint64(0x2545F4914F6CDD1D) >> np.uint64(64 - size)
            counts.append(model.counts[k][slot.astype(np.int64)])
            inputs.append(model.inputs[k][slot.astype(np.int64)])
        weights = model.weights[mixing.gate(counts, at)]
        x = model.refine(sum(weights[:, k] * v for k, v in enumerate(inputs)), np.array([partial]))
        total -= np.logaddexp(0, -x if bit else x)[0] / np.log(10)
    return total


def test_mixer_learns_from_every_unit(spark, text, monkeypatch):
    many = collections.Counter(u for i in range(300) for u in mixing.units_of(text(i, 200)))
    assert sum(many.values()) > 50_000
    tables = [np.zeros((1 << bits, 2), np.int32) for _, bits in mixing.CONTEXTS]
    mixing.count_tables(list(many), np.array(list(many.values()), np.int32), tables)
    first, whole, held = mixing.Learning(), mixing.Learning(), []
    whole.see(tables, list(many), np.array(list(many.values())))
    monkeypatch.setattr(mixing.Learning, "model", lambda self, tables: held.append(self))
    rows = spark.createDataFrame([(bytearray(u), n) for u, n in many.items()], "unit binary, n long")
    mixing._learned(rows, tables, 3)
    assert np.allclose(held[0].pull, whole.pull) and not np.allclose(held[0].pull, first.pull)
    one = mixing.Learning()
    for unit, n in list(many.items())[:2000]:  # the sums count each unit as often as it occurs
        one.see(tables, [unit], np.array([n])) if n > 50 else None
    often = [(u, n) for u, n in list(many.items())[:2000] if n > 50]
    again = mixing.Learning()
    again.see(tables, [u for u, n in often for _ in range(n)], np.ones(sum(n for _, n in often), int))
    assert np.allclose(one.pull, again.pull)


def test_inputs_of_many_words_take_little_memory():
    r = np.random.default_rng(3)
    p, count = toxicity.fresh().p, 20_000
    numbers = r.integers(0, 2**63, count, dtype=np.uint64)
    grams, real = r.integers(0, 1 << toxicity.CHAR_BITS, (count, 90), dtype=np.uint16), r.random((count, 90)) < 0.5
    tracemalloc.start()
    got = toxicity.word_inputs(p, numbers, grams, real)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 40 << 20  # the vectors of all n-grams at once: 165 MB
    some = [0, 1023, 1024, count - 1]
    assert np.array_equal(got[some], toxicity.word_inputs(p, numbers[some], grams[some], real[some]))


def test_words_of_a_long_sample_have_the_grams_that_each_has_alone():
    texts = [f"{'w' * (at % 20 + 1)}{at}" for at in range(3000)]
    words = toxicity.prepared(texts)
    assert words.grams.dtype == np.uint16 and len(words.numbers) == 3000
    for at in (0, 1500, 2999):
        alone, own = toxicity.prepared([texts[at]]), int(words.windows[at][0])
        assert words.grams[own][words.real[own]].tolist() == alone.grams[0][alone.real[0]].tolist()


def test_few_units_fill_few_copies_of_the_tables(spark, monkeypatch):
    from pyspark.sql.classic.dataframe import DataFrame

    made = []
    monkeypatch.setattr(DataFrame, "repartition", lambda self, *to: made.append(to) or self)
    units = spark.createDataFrame([(f"unit{i} ".encode(), 1 + i % 3) for i in range(500)], "unit binary, n long").repartitionByRange(40, "unit")
    counted = mixing._tables(units, 2)
    assert not made  # however many partitions a shuffle has
    whole = [np.zeros((1 << size, 2), np.int32) for _, size in mixing.CONTEXTS]
    mixing.count_tables([f"unit{i} ".encode() for i in range(500)], np.array([1 + i % 3 for i in range(500)], np.int32), whole)
    assert all(np.array_equal(a, b) for a, b in zip(counted, whole))


def test_gradients_of_many_words_take_little_memory(monkeypatch):
    count = 6000
    words = toxicity.prepared([" ".join(f"{'w' * 18}{at:06d}" for at in range(begin, begin + 30)) for begin in range(0, count, 30)])
    p, labels, weight = toxicity.fresh().p, np.arange(len(words.windows)) % 2, np.ones(len(words.windows))
    tracemalloc.start()
    got = toxicity.gradients(p, words, words.windows, labels, weight)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 45 << 20  # the vectors of all n-grams at once: 75 MB
    monkeypatch.setattr(toxicity, "LOOKED_UP", count)
    whole = toxicity.gradients(p, words, words.windows, labels, weight)
    assert all(np.array_equal(got[k], whole[k]) for k in whole)
