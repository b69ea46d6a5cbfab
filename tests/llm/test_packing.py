import sys
import zlib

import numpy as np
import pyarrow as pa
import pytest

from quarrylake.llm.packing import END_ID, TIERS, CachedTokenizer, pack
from quarrylake.llm.queries import TOKENIZER, tokenizer_file


@pytest.fixture(scope="module")
def plain():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_file(TOKENIZER))


def ids(plain, text):
    return np.array([*plain.encode(text or "", add_special_tokens=False).ids, END_ID], "<u4")


def test_remembered_ids_equal_the_tokenizers(plain, odd, text):
    coder = CachedTokenizer(tokenizer_file(TOKENIZER), size=50)
    texts = [t or "" for _, t in odd] + [
        "It's a U.S. test, isn't it? 3.14,15 A.B. ... ,. x,y. É, é. á,", "<|startoftext|> <|endoftext|>",
        "tab\tand\x0bline\x85sep end\xa0nbsp \x1cfs", "ΣΑΣ, ΌΣ. İstanbul,",
    ]
    for t in texts * 2:
        assert coder.encode(t) == ids(plain, t)[:-1].tobytes()


def test_ids_before_marks_and_in_slices(plain):
    """Every letter before a mark, special strings and odd white space; texts as a slice of a longer array."""
    coder = CachedTokenizer(tokenizer_file(TOKENIZER), size=5000)
    letters = [chr(i) for i in [*range(1, 0x3400), *range(0xF900, 0x11000)] if not 0xD800 <= i < 0xE000]
    texts = [f"{x}. {x}, A{x}. a.{x} B{x}b,.{x}a {x}a.," for x in letters]
    texts += ["<|ENDOFTEXT|> A.", "x<|endoftext|>.A, A.<|endoftext|>", "", " ", "'S 's'S.'s", "A.\u0301 e\u0301."]
    for at in range(0, len(texts), 1000):
        some = texts[at : at + 1000]
        held = pa.array(["Éé some other text", *some, "the end"]).slice(1, len(some))
        expected = plain.encode_batch_fast(some, add_special_tokens=False)
        for t, want, got in zip(some, expected, coder.encode_all(held)):
            assert got == np.array(want.ids, "<u4").tobytes(), t


def test_pieces_give_back_every_document(spark, documents, odd, plain, text):
    docs = [*odd, *[(100 + i, text(i, 10 * i)) for i in range(60)]]
    rows = pack(documents(*docs).coalesce(2), tokenizer_file(TOKENIZER)).collect()
    expected = sorted((ids(plain, t).tobytes() for _, t in docs), key=lambda b: (len(b), b))
    pieces = sorted(rows, key=lambda r: (str(r.doc_id), r.start))
    starts = [r for r in pieces if r.start == 0]
    assert len(starts) == len(docs)
    assert sum(r.length for r in rows) == sum(len(b) // 4 for b in expected)
    unique = [(i, t) for i, t in docs if i is not None and i >= 4]
    for i, t in unique:
        own = [r for r in pieces if r.doc_id == i]
        assert b"".join(bytes(r.ids) for r in own) == ids(plain, t).tobytes()
        assert [r.start for r in own] == list(np.cumsum([0, *[r.length for r in own]])[:-1])
        assert {r.doc_tokens for r in own} == {len(ids(plain, t))}
    windows = {}
    for r in rows:
        windows.setdefault(r.sequence_id, []).append(r)
    for inside in windows.values():
        inside.sort(key=lambda r: r.offset)
        assert [r.offset for r in inside] == list(np.cumsum([0, *[r.length for r in inside]])[:-1])
        size = sum(r.length for r in inside)
        assert size == inside[0].window_size <= 4096 and size & (size - 1) == 0
    short = [w for w in windows.values() if w[0].window_size < TIERS[0]]
    assert len(short) <= 2 * 8  # the ends of two partitions
    assert zlib.crc32(bytes(rows[0].ids)) >= 0


def test_steps_hold_windows_of_one_size(spark, documents, text):
    docs = documents(*[(i, text(i, 150)) for i in range(300)]).coalesce(1)
    rows = pack(docs, tokenizer_file(TOKENIZER), step_tokens=4096).collect()
    steps = {}
    for r in rows:
        steps.setdefault(r.step_id, {})[r.sequence_id] = r.window_size
    for inside in steps.values():
        assert len(set(inside.values())) == 1 and sum(inside.values()) <= 4096


def test_empty_table_and_bad_tiers(spark, documents):
    assert pack(documents(), tokenizer_file(TOKENIZER)).count() == 0
    with pytest.raises(ValueError, match="tiers"):
        pack(documents(), tokenizer_file(TOKENIZER), tiers=(256, 1000))


def test_words_before_marks_are_those_of_the_tokenizer(plain):
    """Every letter beyond ASCII before a full stop or comma, alone and after another one."""
    coder = CachedTokenizer(tokenizer_file(TOKENIZER), size=10**7)
    letters = [c for c in map(chr, range(128, sys.maxunicode + 1)) if c.isalpha()]
    words = [word for c in letters for word in (f"{c}.", f"a{c},")]
    for start in range(0, len(words), 20_000):
        part = words[start : start + 20_000]
        coded = plain.encode_batch_fast(part, add_special_tokens=False)
        wrong = [w for w, c in zip(part, coded) if np.frombuffer(coder.encode(w), "<u4").tolist() != c.ids]
        assert not wrong
