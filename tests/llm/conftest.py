import random

import pytest

LETTERS = "abcdefgh"


@pytest.fixture()
def words():
    """A maker of random texts from a seed."""

    def make(n, seed=0):
        r = random.Random(seed)
        return " ".join("".join(r.choice(LETTERS) for _ in range(r.randint(1, 7))) for _ in range(n))

    return make


@pytest.fixture()
def frame(spark):
    """Documents with columns whose names clash with those that operators make."""

    def make(rows):
        return spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, words string, score int")

    return make
