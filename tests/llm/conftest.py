import os
import random
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture
def prose():
    """A source of sentences from a fixed list of words."""
    rng = random.Random(5)
    vocabulary = ["".join(rng.choice("abcdeéghiñlmnoprst") for _ in range(rng.randint(2, 9))) for _ in range(3000)]

    def make(n, seed=None):
        draw = random.Random(seed) if seed is not None else rng
        return " ".join(draw.choice(vocabulary) for _ in range(n))

    return make


@pytest.fixture
def table(spark):
    """Documents with a clashing extra column, from (doc_id, text) pairs."""

    def make(rows):
        return spark.createDataFrame(
            [(i, t, "x", 1) for i, t in rows], "doc_id long, text string, size string, n_words int"
        )

    return make
