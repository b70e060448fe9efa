from __future__ import annotations

import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def documents(spark):
    """Makes a documents table of (doc_id, text) pairs."""

    def make(rows):
        return spark.createDataFrame([(i, t, None, "s", None) for i, t in rows], SCHEMA)

    return make


@pytest.fixture
def prose():
    """Invented sentences of n words."""
    words = [f"{a}{b}{c}" for a in ("ba", "ko", "ti", "mu") for b in ("ra", "le", "no", "zi") for c in ("", "s", "n", "kal")]

    def make(n, seed):
        r = random.Random(seed)
        return " ".join(r.choice(words) for _ in range(n))

    return make


def edges(text):
    """Rows that every operator has to bear: nulls, empty texts, white space, repeated rows and ids."""
    return [(None, text), (None, None), (1, None), (2, ""), (3, " \n\t "), (4, text), (4, text), (5, text.upper()), (6, "é" * 70_000)]
