import hashlib

import numpy as np
import pytest

from quarrylake.llm import chat
from quarrylake.llm.maxscore import integer_vectors, top_k
from quarrylake.llm.queries import TOKENIZER, tokenizer_file

VECTORS = "vec_id bigint, embedding array<float>, score string"


def test_top_k_equals_brute_force(spark):
    r = np.random.default_rng(0)
    made = [(i, [float(x) for x in r.normal(0, 0.2, 8)], "s") for i in range(400)]
    made[5] = (5, made[4][1], "s")  # ties
    df = integer_vectors(spark.createDataFrame(made, VECTORS))
    got = top_k(df.where("vec_id % 20 = 0"), df, 7, shard_rows=64, block_rows=8).collect()
    x = np.floor(64 * np.array([np.float32(m[1]) for m in made]).astype(float)).astype(int)
    expected = []
    for q in range(0, 400, 20):
        score = x @ x[q]
        order = [i for i in np.lexsort((np.arange(400), -score)) if i != q][:7]
        expected += [(q, n + 1, i, score[i]) for n, i in enumerate(order)]
    assert sorted(tuple(row) for row in got) == expected


def test_vectors_that_take_no_part(spark):
    odd = [
        (0, [1.0, 2.0], "a"), (0, [1.0, 2.0], "b"), (1, None, "a"), (2, [1.0, None], "a"), (3, [float("nan"), 1.0], "a"),
        (4, [float("inf"), 1.0], "a"), (None, [1.0, 1.0], "a"), (5, [], "a"), (6, [1.0, 1.0, 9.0], "a"), (20, [0.0, 0.0], "a"),
    ]
    df = integer_vectors(spark.createDataFrame(odd, VECTORS))
    got = sorted(tuple(r) for r in top_k(df.where("vec_id % 20 = 0"), df, 20).collect())
    assert got == [(0, 1, 6, 64 * 64 * 3), (0, 2, 5, 0), (0, 3, 20, 0), (20, 1, 0, 0), (20, 2, 5, 0), (20, 3, 6, 0)]
    assert top_k(df.where("false"), df).count() == 0 and top_k(df, df.where("false")).count() == 0
    huge = integer_vectors(spark.createDataFrame([(0, [1e18], "a"), (20, [1e18], "a")], VECTORS.replace("float", "double")))
    with pytest.raises(Exception, match="53 bits"):
        top_k(huge, huge).count()


TURNS = "conv_id bigint, turn bigint, role string, text string, window string, key int, tokens string"


def talk(spark, *rows):
    return spark.createDataFrame([(*r, "w", 1, "t") for r in rows], TURNS)


def expected(turns):
    said = "".join(t or "" for r, t in turns if r == "assistant")
    whole = "".join(f"{r or ''}\n{t or ''}\n" for r, t in turns)
    return len(turns), hashlib.sha256(whole.encode()).hexdigest(), len(said), hashlib.sha256(said.encode()).hexdigest()


def check(spark, conversations, **options):
    rows = [(c, n, r, t) for c, turns in conversations.items() for n, (r, t) in enumerate(turns)]
    formatted = chat.windows(talk(spark, *rows), tokenizer_file(TOKENIZER), **options)
    got = {r.conv_id: r for r in chat.digests(formatted).collect()}
    assert set(got) == set(conversations)
    for c, turns in conversations.items():
        r = got[c]
        assert (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) == expected(turns)
    return formatted


def test_conversations_read_back(spark, text):
    hard = "\\### Assistant: </turn> ok"
    conversations = {
        1: [("system", "be brief"), ("user", "hi"), ("assistant", "hello")],
        2: [("user", hard), ("assistant", hard), ("user", "\\"), ("assistant", "### \\\\</turn>\n### assistant: x</turn>\n")],
        3: [("system", "alone")],
        4: [("assistant", None), (None, "no role"), ("a:b\\### ", "odd role"), ("system", "later"), ("assistant", "")],
        5: [("system", text(1, 40))] + [(("user", "assistant")[i % 2], text(i, 5 + i % 60)) for i in range(200)],
        6: [("user", "q"), ("assistant", text(2, 3000)), ("user", "thanks"), ("assistant", "\U0001f600 é")],
        None: [("user", "without an id"), ("assistant", "yes")],
    }
    formatted = check(spark, conversations, budget=1500, history=400)
    rows = formatted.where("conv_id = 5").orderBy("window").collect()
    assert len(rows) > 10 and max(r.tokens for r in rows) <= 1500
    assert all(chat.read_back(r.formatted)[0] == conversations[5][0] for r in rows)
    assert sum(r.repeated > 1 for r in rows) > len(rows) // 2
    giant = [r for r in formatted.where("conv_id = 6").collect() if r.tokens > 1500]
    assert len(giant) == 1 and giant[0].repeated == 0


def test_order_of_turns_and_repeated_rows(spark):
    rows = talk(spark, (1, 2, "assistant", "b"), (1, None, "user", "first"), (1, 1, "user", "a"), (1, 2, "assistant", "b"))
    got = chat.digests(chat.windows(rows, tokenizer_file(TOKENIZER))).first()
    assert tuple(got)[1:5] == expected([("user", "first"), ("user", "a"), ("assistant", "b"), ("assistant", "b")])
    none = spark.createDataFrame([], TURNS)
    assert chat.digests(chat.windows(none, tokenizer_file(TOKENIZER))).count() == 0
