import random

import pytest

pytest.importorskip("lapsewise.llm")

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session")
def make(spark):
    """Documents of (doc_id, text), with more columns whose names operators use inside."""

    def build(rows, lang="en"):
        full = [(i, t, lang, None, None if t is None else len(t), "x", 7, None) for i, t in rows]
        return spark.createDataFrame(full, SCHEMA + ", id string, n bigint, key string")

    return build


@pytest.fixture(scope="session")
def prose():
    """Texts of invented words; the seed makes the text."""

    def build(seed, n, words=400):
        draw = random.Random(seed)
        return " ".join(f"w{draw.randrange(words)}{draw.choice('abcdefgh')}" for _ in range(n))

    return build


@pytest.fixture(scope="session")
def odd(prose):
    """Nulls in any column, empty, blank and very long texts, repeated rows and ties."""
    long = prose(1, 30_000, 5000)
    return [
        (1, None),
        (2, ""),
        (3, " \n\t "),
        (4, "one two"),
        (4, "one two"),
        (5, long),
        (6, long),
        (7, "漢字 😀 \x00 '\" \\ \r\n İß"),
        (8, "x" * 70_000),
    ]
