from __future__ import annotations

import random

import pytest

CLASHING = "id long, sum long, ranges int, component int, node int, bucket int, rep int, label int, score double, size int"


@pytest.fixture
def documents(spark):
    """Frame of documents from (doc_id, text) or (doc_id, text, lang), with columns of names used inside."""

    def build(*rows):
        full = [(*row, *([None] * (3 - len(row))), *range(10)) for row in rows]
        full = [tuple(float(v) if i == 11 else v for i, v in enumerate(row)) for row in full]
        return spark.createDataFrame(full, f"doc_id long, text string, lang string, {CLASHING}")

    return build


@pytest.fixture
def prose():
    """Texts of random words; equal seeds give equal texts."""

    def build(n_words, seed, words=400, line=9):
        source = random.Random(seed)
        said = [f"w{source.randrange(words)}" for _ in range(n_words)]
        return "\n".join(" ".join(said[i : i + line]) for i in range(0, n_words, line))

    return build


#: Rows that every operator must take: null and repeated ids, null, empty and blank texts, ties.
ODD_ROWS = [
    (None, "a b c d e f"),
    (None, None),
    (1, None),
    (2, ""),
    (3, " \n\t "),
    (4, "one"),
    (5, "a b c d e f"),
    (6, "a b c d e f"),
    (6, "a b c d e f"),
    (7, "Été 漢字 😀 <|endoftext|> \x01 ?"),
]


@pytest.fixture
def odd(documents):
    return documents(*ODD_ROWS)
