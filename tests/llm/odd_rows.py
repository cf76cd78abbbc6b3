from __future__ import annotations

import random

import pytest

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, score string, size string, tokens string, "
    "secrets string, copies string, rate string, target string, key string, root string, n_words string, kept string"
)


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in every column, empty and very long texts, repeated rows, columns with clashing names."""
    draw = random.Random(3)
    words = ["the", "and", "of", "rain", "river", "stone", "light", "paper", "é", "straße", "10", "#"]
    prose = [" ".join(draw.choice(words) for _ in range(n)) for n in (3, 60, 200, 40_000)]
    rows = [
        (1, None, "en", "a"),
        (2, "", "en", None),
        (3, " \t\n ", None, "b"),
        (4, prose[0], "en", "a"),
        (4, prose[0], "en", "a"),
        (5, prose[1], None, None),
        (None, prose[2], "en", "b"),
        (None, None, None, None),
        (6, prose[3], "en", "c"),
        (7, "x" * 200_000, "en", "c"),
        (8, "!!! ??? 123", "de", "c"),
    ]
    extra = ["clash"] * 11
    return spark.createDataFrame([(*r, None if r[1] is None else len(r[1]), *extra) for r in rows], SCHEMA)


@pytest.fixture(scope="session")
def nothing(odd):
    return odd.where("false")
