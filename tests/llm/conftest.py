import random

import pytest


def prose(seed: int, words: int) -> str:
    r = random.Random(seed)
    parts = ["ka", "lo", "mi", "ten", "ru", "sha", "vol", "dre", "pin", "gor", "ast", "ell"]
    return " ".join("".join(r.choice(parts) for _ in range(r.randint(1, 4))) for _ in range(words))


@pytest.fixture(scope="session")
def text():
    return prose


@pytest.fixture
def documents(spark):
    """Documents from (doc_id, text), with columns whose names clash with those of the operators."""

    def make(*rows, lang=None, source="s"):
        schema = (
            "doc_id bigint, text string, lang string, source string, n_chars bigint, score double, version string,"
            " content int, block string, shard int, band int, line_no string, words int"
        )
        full = [(i, t, lang, source, None if t is None else len(t), 1.0, "v", 1, "b", 2, 3, "l", 4) for i, t in rows]
        return spark.createDataFrame(full, schema)

    return make


@pytest.fixture
def odd(text):
    """Null and empty texts, a null id, repeated rows, signs only, a very long text and a very long word."""
    return [
        (1, None), (2, ""), (None, text(1, 40)), (3, text(2, 50)), (3, text(2, 50)), (4, " \n\t\n "), (5, "?! -- ..."),
        (6, text(3, 30_000)), (7, "x" * 100_000), (8, "One."), (3, text(4, 20)), (9, "é ü ñ ß 中文 \x1c \U0001f600"),
    ]
