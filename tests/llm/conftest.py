from __future__ import annotations

import random

import pytest

SCHEMA = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint, row string, v int,"
    " mark string, place int, span int, label int, score string, hits int, n int, path string"
)
CLASH = ("x", 1, "y", 2, 3, 4, "z", 5, 6, "p")


def sentence(rng: random.Random, n: int, size: int = 400) -> str:
    return " ".join(f"w{rng.randrange(size)}" for _ in range(n))


def odd_rows() -> list[tuple]:
    """Nulls, empty and long texts, repeated rows and ids, and columns with clashing names."""
    rng = random.Random(1)
    base = sentence(rng, 120)
    texts = [
        (0, None), (1, ""), (2, "   \n\t "), (3, "word"), (4, base), (5, base),
        (6, base + " tail"), (7, sentence(rng, 20_000)), (7, sentence(rng, 50)), (8, "éàü 漢字 😀 ok"),
        (None, base + " other end"), (None, None), (9, sentence(rng, 60)), (9, sentence(rng, 60)),
    ]
    again = texts[-1]
    rows = [*texts, again, again]
    return [(i, t, None, "s", None if t is None else len(t), *CLASH) for i, t in rows]


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def make(spark):
    def build(texts, first: int = 0):
        rows = [(first + i, t) for i, t in enumerate(texts)]
        return spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)

    return build
