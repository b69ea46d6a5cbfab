import itertools
import re

import numpy as np
import pytest

from quarrylake.llm import bandjoin, decontam, linededup, neardup, substring
from quarrylake.llm.common import connected, joined, shingles_of, words_of

ODD_IDS = (None, 1, 2, 3, 4, 5, 6, 7, 8, 9)


def edited(text, places, word="changed"):
    words = text.split(" ")
    for p in places:
        words[p] = word
    return " ".join(words)


def test_words_and_shingles():
    words, starts, ends = words_of("Ab, ab  Été été.\nx1")
    assert words[0] == words[1] and words[2] != words[3]  # only A-Z is folded
    assert [b"Ab, ab"[s:e] for s, e in zip(starts[:2], ends[:2])] == [b"Ab", b"ab"]
    assert len(shingles_of(words, 5)) == 1 and len(shingles_of(words[:3], 5)) == 1 and not len(shingles_of(words[:0], 5))
    assert not len(words_of(None)[0]) and not len(words_of("?!")[0])
    assert len(words_of("x" * 100, 24)[0]) == 5


def test_components_of_long_chains(spark):
    chain = [(i, i + 1) for i in range(0, 40)] + [(100, 101), (101, 100), (7, 7)]
    got = dict(connected(spark.createDataFrame(chain, "a int, b int"), "chain").collect())
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100}
    assert connected(spark.createDataFrame([], "a int, b int"), "none").count() == 0


def test_near_duplicates(spark, documents, odd, text):
    base = [text(50 + i, 200) for i in range(4)]
    docs = [
        *odd, (20, base[0]), (21, base[0]), (22, edited(base[0], [100])), (23, edited(base[0], [10, 190])), (24, base[1]),
        (25, edited(base[1], range(0, 200, 8))), (26, base[2].upper()), (27, base[2].replace(" ", ",  ")), (28, base[3]),
    ]
    got = {}
    for r in neardup.classes(documents(*docs)).collect():
        got.setdefault(r.doc_id, set()).add(r.class_id)
    assert {i: got[i] for i in range(20, 29)} == {20: {20}, 21: {20}, 22: {20}, 23: {20}, 24: {24}, 25: {25}, 26: {26}, 27: {26}, 28: {28}}
    assert got[1] == got[2] == {1} and len(got[3]) == 2 - (got[3] == {3})
    kept = neardup.one_of_each(documents(*docs))
    assert kept.columns == documents().columns
    ids = sorted(r.doc_id for r in kept.collect() if r.doc_id is not None)
    assert [i for i in ids if i >= 20] == [20, 24, 25, 26, 28] and ids.count(3) == 1
    assert neardup.classes(documents()).count() == 0 and neardup.one_of_each(documents()).count() == 0


def test_samples_agree_as_often_as_sets_are_similar():
    r = np.random.default_rng(1)
    keys = np.sort(r.integers(0, 2**63, 3000, dtype=np.uint64))
    w = r.gamma(2, 1, 3000).astype(np.float32)
    a, b = (keys[:2700], w[:2700]), (keys[300:], w[300:] * np.float32(1.1))
    true = neardup.weighted_jaccard(a, b)
    same = np.mean([neardup.samples(a[0] + np.uint64(i), a[1]) == neardup.samples(b[0] + np.uint64(i), b[1]) for i in range(60)])
    assert abs(same - true) < 0.05


def test_large_group_of_near_copies_is_one_class(spark, documents, text):
    base = text(77, 120)
    docs = documents(*[(i, edited(base, [i % 120], f"w{i}")) for i in range(300)])
    assert neardup.classes(docs).select("class_id").distinct().count() == 1


def lines_brute(docs):
    rows = sorted({(i is not None, i, t or "") for i, t in docs}, key=lambda r: (r[0], r[1] or 0))
    lines = []
    for _, i, t in rows:
        for n, line in enumerate(t.split("\n")):
            words = frozenset(re.split(r"[ \t\r\f\x0b]+", line.lower())) - {""}
            if len(words) >= linededup.MIN_WORDS:
                lines.append((i, n, words))
    gone = {}
    for b, (i, n, words) in enumerate(lines):
        for j, m, other in lines[:b]:
            if len(words & other) * 100 >= len(words | other) * 80:
                gone.setdefault((i, n), set()).add((j, m, len(words & other) / len(words | other)))
    return gone


def test_lines_equal_brute_force(spark, documents, odd, text):
    pool = [text(900 + i, 4 + i % 25) for i in range(40)]
    pool += [edited(p, [0]) for p in pool] + [edited(p, [len(p.split()) - 1], "other") for p in pool[:20]]
    docs = [(100 + i, "\n".join(pool[(i * 7 + k * 11) % len(pool)] for k in range(6))) for i in range(40)]
    odd_once = [(i, t) for i, t in odd if i != 3]
    got = {(r.doc_id, r.line_no): r for r in linededup.later_matches(documents(*docs, *odd_once)).collect()}
    expected = lines_brute([*docs, *odd_once])
    assert got.keys() == expected.keys()
    for key, r in got.items():
        assert (r.kept_doc_id, r.kept_line_no, r.similarity) in expected[key]
        assert r.exact == any(s == 1.0 for _, _, s in expected[key])


def test_documents_without_repeated_lines(spark, documents):
    one, two, short = "alpha beta gamma delta", "one two three four five", "Is."
    docs = documents((1, f"{one}\n{short}"), (2, f"{one}\n{two}\n{short}"), (3, f"{one}\n{short}"), (4, short), (5, None), (6, ""))
    got = {r.doc_id: (r.text, r.n_chars) for r in linededup.clean(docs).collect()}
    text = f"{two}\n{short}"
    assert got == {1: (f"{one}\n{short}", 26), 2: (text, len(text)), 4: (short, 3), 5: (None, None), 6: ("", 0)}
    assert linededup.clean(docs).columns == docs.columns and linededup.clean(documents()).count() == 0


def test_hubs_of_words_need_no_window(spark):
    rows = spark.createDataFrame([(w, s, s, 5, 0, 0, 1) for w in (1, 2) for s in range(9, w, -1)], "word int, set long, first long, n int, parity0 long, parity1 long, at int")
    got = linededup._with_hubs(rows)
    assert "Window" not in got._jdf.queryExecution().toString()
    assert {(r.word, r.hub.set) for r in got.collect()} == {(1, 2), (2, 3)} and got.count() == rows.count()


def test_documents_keep_short_lines_of_their_own(spark, documents):
    one = "alpha beta gamma delta"
    docs = documents((1, f"{one}\nIs."), (2, f"{one}\nAre so"), (3, f"{one}\n is."), (4, f"{one}\n \n"), (5, f"{one}\nare so\nis."), (None, "Null"), (6, f"{one}\nnull"))
    got = {r.doc_id: r.text for r in linededup.clean(docs).collect()}
    assert got == {1: f"{one}\nIs.", 2: "Are so", None: "Null"}


def test_lines_without_spaces(spark, documents):
    shared, others = "版权所有请勿转载本站内容归作者", ["今天天气很好我们去公园散步吧", "ฉันชอบกินข้าวผัดทุกวันตอนเย็น", "これは日本語の文章ですよろしく"]
    docs = documents(*[(i, f"{shared}{'們' * (i == 2)}\n{own}") for i, own in enumerate(others)], (9, "版权 所有 请勿\n今天"), (10, "版权 所有 请勿\n好的"))
    got = {r.doc_id: r.text for r in linededup.clean(docs).collect()}
    assert got == {0: f"{shared}\n{others[0]}", 1: others[1], 2: others[2], 9: "版权 所有 请勿\n今天", 10: "好的"}


def test_passages_equal_brute_force(spark, documents, odd, text):
    base = [text(300 + i, 60) for i in range(12)]
    variants = base + [edited(b, [5, 50]) for b in base[:6]] + [edited(b, range(0, 60, 5)) for b in base[6:]]
    docs = [(100 + i, "\n".join([text(2000 + i, 40), variants[i % 24], variants[(i * 5) % 24]])) for i in range(60)]
    docs += [(i, t) for i, t in odd if i != 3]
    lines = []
    for i, t in sorted(docs, key=lambda d: (d[0] is not None, d[0] or 0)):
        for n, line in enumerate((t or "").split("\n")):
            words = words_of(line)[0]
            if len(words) >= substring.MIN_WORDS:
                lines.append(((i, n), np.unique(shingles_of(words, 5))))
    root = list(range(len(lines)))
    for a, b in itertools.combinations(range(len(lines)), 2):
        if substring.jaccard(lines[a][1], lines[b][1]) >= 0.8:
            root = [min(root[a], root[b]) if r in (root[a], root[b]) else r for r in root]
    expected = {lines[k][0]: lines[root[k]][0] for k in range(len(lines)) if root[k] != k}
    got = {(r.doc_id, r.line_no): (r.kept_doc_id, r.kept_line_no) for r in substring.repeated(documents(*docs)).collect()}
    assert got == expected
    assert substring.repeated(documents()).count() == 0


def test_equal_runs_are_found_whatever_the_lines(spark, documents, odd, text):
    runs = [text(400 + i, 37 + i) for i in range(20)]
    docs = [(100 + i, f"{text(4000 + i, 150)} {run}, {text(4100 + i, 150)}") for i, run in enumerate(runs)]
    docs += [(200 + i, f"{text(4200 + i, 9 * i)} {run} {text(4300 + i, 80)}") for i, run in enumerate(runs)]
    broken = ["\n".join(" ".join(run.split()[k : k + 8]) for k in range(0, 99, 8)) for run in runs]
    docs += [(300 + i, f"É\n{text(4400 + i, 7)}\n{run}\n{text(4500 + i, 9)}") for i, run in enumerate(broken)]
    docs += [(400, f"{runs[0]} . {text(4600, 30)} {runs[0]}"), *((i, t) for i, t in odd if i != 3)]
    texts = dict(docs)
    got = {}
    for r in substring.spans(documents(*docs)).collect():
        own = words_of(texts[r.doc_id][r.start : r.end])[0]
        assert r.words == len(own) >= substring.WINDOW and texts[r.doc_id][: r.start].count("\n") == r.line_no
        kept = texts[r.kept_doc_id][r.kept_start :]
        assert (own == words_of(kept)[0][: len(own)]).all() and texts[r.kept_doc_id][: r.kept_start].count("\n") == r.kept_line_no
        got.setdefault(r.doc_id, []).append((r.kept_doc_id, texts[r.doc_id][r.start : r.end].split()))
    assert got.keys() == {400} | {n + i for n in (200, 300) for i in range(20)} and len(got[400]) == 2
    for i, run in enumerate(runs):  # a chance neighbour can make one more window, held by 200 + i
        assert (100 + i, run.split()) in got[200 + i] and (100 + i, run.split()) in got[300 + i]
        assert {k for k, _ in got[200 + i]} == {100 + i} and {k for k, _ in got[300 + i]} <= {100 + i, 200 + i}
    assert substring.spans(documents()).count() == 0


def test_tuned_bands_reach_the_recall():
    bands, rows = substring.tune()
    assert 1 - (1 - 0.8**rows) ** bands >= substring.RECALL
    assert 1 - (1 - 0.3**rows) ** bands <= substring.CHANCE


@pytest.fixture
def benchmark(spark):
    return lambda *rows: spark.createDataFrame(list(rows), "item_id bigint, text string")


def test_benchmark_items_in_documents(spark, documents, odd, text, benchmark):
    items = [(i, text(600 + i, 14 + i)) for i in range(30)] + [(90, None), (91, ""), (92, "two words"), (0, text(600, 14))]
    docs = [(100 + i, f"{text(700 + i, 80)} {text(600 + i, 14 + i).upper()}. {text(800 + i, 30)}") for i in range(0, 30, 2)]
    docs += [
        (200, edited(text(620, 34), [17])), (201, edited(text(621, 35), range(0, 35, 4))), (202, "Two, words"),
        (203, "here two words stand"), (204, text(625, 39)[20:]), *odd,
    ]
    got = {(r.doc_id, r.item_id) for r in decontam.contaminated(documents(*docs), benchmark(*items)).collect()}
    assert {(100 + i, i) for i in range(0, 30, 2)} <= got and (202, 92) in got
    assert not {d for d, _ in got} & {201, 203, *ODD_IDS}
    row = decontam.contaminated(documents(docs[1]), benchmark(*items)).first()
    assert docs[1][1][row.start : row.end].lower() == text(602, 16)
    kept = decontam.clean(documents(*docs), benchmark(*items))
    assert kept.columns == documents().columns
    assert {r.doc_id for r in kept.collect()} == {i for i, _ in docs} - {d for d, _ in got}
    assert decontam.contaminated(documents(), benchmark(*items)).count() == 0
    assert decontam.clean(documents(*docs), benchmark()).count() == len(docs)


def test_many_items_go_in_blocks(spark, documents, text, benchmark, monkeypatch):
    items = [(i, text(600 + i, 20)) for i in range(9)]
    docs = documents(*[(i, f"a b {t} c d") for i, t in items])
    whole = sorted(decontam.contaminated(docs, benchmark(*items)).collect())
    monkeypatch.setattr(decontam, "ITEMS_AT_ONCE", 2)
    assert len(whole) == 9 and sorted(decontam.contaminated(docs, benchmark(*items)).collect()) == whole
    assert decontam.clean(docs, benchmark(*items)).count() == 0


def test_index_finds_every_print_within_the_radius():
    r = np.random.default_rng(2)
    items = decontam.Items.of([(i, " ".join(map(str, r.integers(0, 10**6, 20)))) for i in range(300)], np.ones(1 << neardup.FREQUENCY_BITS, np.float32))
    for _ in range(200):
        print_ = np.packbits(np.unpackbits(items.prints[r.integers(300)]) ^ (r.random(64) < 0.2))
        close = np.flatnonzero(decontam._POPULATION[items.prints ^ print_].sum(axis=1, dtype=int) <= decontam.RADIUS)
        found = np.unique(np.concatenate([items.index[b][v] for b, v in enumerate(print_)]))
        assert set(close) <= set(found)


def test_members_of_the_largest_component_meet_the_others_only(spark, monkeypatch):
    dealt = []
    group = type(spark.range(1)).groupBy

    def spy(self, *columns):
        if [str(c) for c in columns] == ["band", "p", "q"]:
            dealt.extend(self.select("p", "q", "block", "content").collect())
        return group(self, *columns)

    monkeypatch.setattr(type(spark.range(1)), "groupBy", spy)
    monkeypatch.setattr(bandjoin, "BLOCK", 10)
    # numbers that differ by 2 at most are similar: 0 to 199 hang together with the hub, 500 to 509 lie apart, as 900 and 901
    at = [0, *range(1, 200), *range(500, 510), 900, 901]
    near = {0: range(200)}
    similarity = lambda a, b: 0.9 if abs(a - b) <= 1 or {a, b} <= set(near[0]) and 0 in (a, b) else 0.75
    contents = spark.createDataFrame([(i, [7]) for i in at], "content long, bands array<long>")
    texts = lambda wanted: wanted.select("content", wanted["content"].cast("string").alias("text"))
    got = dict(bandjoin.components(contents, texts, int, similarity, 0.8, "largest").collect())
    assert {got[i] for i in range(200)} == {0} and {got[i] for i in range(500, 510)} == {500} and got[900] == got[901] == 900
    assert {r.content for r in dealt} == set(at) - {0}
    assert len(dealt) < 5 * 199 < 20 * 199  # 211 members in 22 blocks would be 4642 rows


def test_a_set_meets_one_hub_before_others(spark, documents, monkeypatch):
    verified, similar = [], linededup._similar

    def spy(docs, id_column, text_column, pairs, *more):
        verified.append(pairs.count())
        return similar(docs, id_column, text_column, pairs, *more)

    monkeypatch.setattr(linededup, "_similar", spy)
    words = [f"w{i}" for i in range(20)]
    docs = [(i, " ".join(edited(" ".join(words), [i % 20], f"x{i}").split())) for i in range(60)]
    got = {(r.doc_id, r.line_no) for r in linededup.later_matches(documents(*docs)).collect()}
    assert got == lines_brute(docs).keys()
    assert verified[0] <= 59


def test_texts_of_a_batch_have_the_paragraphs_and_sketches_that_each_has_alone(text):
    texts = ["", text(1, 30) + "\n" + text(2, 10) + "\n\n" + text(3, 400), "x\n\n", text(4, 24), "\n" + text(5, 25)]
    ((raw, places),) = joined(texts)
    of, line, first, count, words = substring.paragraphs(raw, places)
    assert list(zip(of, line, count)) == [(1, 0, 30), (1, 3, 400), (4, 1, 25)]
    values, contents = substring.sketches(words, first, count, 11, 3), substring.contents_of(words, first, count)
    for at, (t, n) in enumerate([(1, 0), (1, 3), (4, 1)]):
        alone = substring.paragraphs(texts[t].split("\n")[n].encode(), np.array([0]))
        assert (substring.sketches(alone[4], alone[2], alone[3], 11, 3)[0] == values[at]).all()
        assert substring.contents_of(alone[4], alone[2], alone[3])[0] == contents[at]


def test_similarities_of_blocks_are_those_of_pairs(monkeypatch):
    monkeypatch.setattr(substring, "COLUMNS", 7)
    r = np.random.default_rng(2)
    left, right = ([np.unique(r.integers(0, 60, 25, dtype=np.uint64)) for _ in range(n)] for n in (9, 6))
    assert np.allclose(substring.jaccards(left, right), [[substring.jaccard(a, b) for b in right] for a in left])
    assert not substring.jaccards(left, [np.array([1000], np.uint64)]).any()


def test_windows_are_shuffled_once(spark, documents, text, monkeypatch):
    plans = []
    monkeypatch.setattr(substring, "written", lambda df, purpose: plans.append((purpose, df._jdf.queryExecution().executedPlan().toString())) or df)
    substring.spans(documents((1, text(1, 60)), (2, text(1, 60))))
    assert [p for p, _ in plans][0] == "window-pairs"  # the windows are not written
    assert plans[0][1].count("hashpartitioning(content") == 1 and "Join" not in plans[0][1]


def test_sets_that_may_match_are_not_written_as_pairs(spark, documents, monkeypatch):
    purposes, written = [], linededup.written
    monkeypatch.setattr(linededup, "written", lambda df, purpose: purposes.append(purpose) or written(df, purpose))
    words = [f"w{i}" for i in range(20)]
    docs = [(i, " ".join(edited(" ".join(words), [i % 20], f"x{i}").split())) for i in range(60)]
    got = {(r.doc_id, r.line_no) for r in linededup.later_matches(documents(*docs)).collect()}
    assert got == lines_brute(docs).keys() and "line-pairs" not in purposes


def test_buckets_come_to_the_driver_without_an_object_each(spark, documents, text, monkeypatch):
    docs = documents((1, text(1, 60)), (2, text(2, 60)), (3, None))
    lines = linededup._lines(docs, "doc_id", "text")

    def refused(self, *args):
        raise AssertionError("rows of buckets as objects")

    for kind in {type(docs), type(docs).__mro__[1]}:
        for name in ("collect", "toPandas"):
            if hasattr(kind, name):
                monkeypatch.setattr(kind, name, refused)
    classes, weights = linededup.rarity_classes(lines), neardup.inverse_frequencies(docs)
    assert len(classes) == 1 << linededup.RARITY_BITS and 0 < sum(map(bool, classes)) <= 120
    assert len(weights) == 1 << neardup.FREQUENCY_BITS and 0 < (weights < 1).sum() <= 112


def test_few_wanted_lines_make_few_bits():
    assert linededup._wanted_bits(0) == 0 and linededup._wanted_bits(1) == 7 and linededup._wanted_bits(1000) == 16
    assert linededup._wanted_bits(10**12) == linededup.WANTED_BITS


def test_runs_around_many_windows_are_found_at_once():
    r = np.random.default_rng(3)
    own = r.integers(0, 2**60, 30_000, dtype=np.uint64)
    other = own.copy()
    other[::60] += np.uint64(1)  # 500 runs of 59 words on one shift
    at = np.sort(r.choice(len(own) - substring.WINDOW, 8000, replace=False))
    at = at[[(own[a : a + substring.WINDOW] == other[a : a + substring.WINDOW]).all() for a in at]]
    calls, real = [], np.flatnonzero
    substring.np.flatnonzero = lambda x: calls.append(1) or real(x)
    try:
        got = substring.extended(own, other, at, at)
    finally:
        substring.np.flatnonzero = real
    assert len(calls) == 1  # not one for each run
    begins = sorted({a // 60 * 60 + 1 for a in at.tolist()})
    assert got[:, 0].tolist() == begins == got[:, 2].tolist() and (got[:, 1] - got[:, 0] == 59).all()
    assert at[got[:, 3]].tolist() == [min(a for a in at.tolist() if a > begin - 1) for begin in begins]


def test_small_blocks_are_compared_without_pandas(spark, monkeypatch):
    monkeypatch.setattr(type(spark.range(1).groupBy("id")), "applyInPandas", None)
    at = [0, 10, 11, 20]
    similarity = lambda a, b: 0.9 if abs(a - b) <= 1 else 0.75
    contents = spark.createDataFrame([(i, [7, i]) for i in at], "content long, bands array<long>")
    texts = lambda wanted: wanted.select("content", wanted["content"].cast("string").alias("text"))
    got = dict(bandjoin.components(contents, texts, int, similarity, 0.8, "small").collect())
    assert got[10] == got[11] == 10
