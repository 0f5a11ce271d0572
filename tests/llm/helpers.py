"""Small tables with the rows that break things, and brute-force versions of what operators compute."""

from __future__ import annotations

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, rep long, key string, bands string, part int, score double, tokens long, component_id long"


def words(rng: random.Random, n: int, alphabet: str = "abcdefghij") -> list[str]:
    return ["".join(rng.choice(alphabet) for _ in range(rng.randint(2, 6))) for _ in range(n)]


def odd_documents(spark):
    """Nulls, empty and very long texts, repeated rows, and columns named like the operators' own."""
    rng = random.Random(5)
    long_text = " ".join(words(rng, 40_000))
    rows = [
        (1, "one two three four five six seven", "en", "a"),
        (1, "one two three four five six seven", "en", "a"),
        (2, None, "en", "a"),
        (3, "", "fr", "b"),
        (4, "   \n\t ", None, "b"),
        (None, "one two three four five six seven", "en", None),
        (5, long_text, "en", "a"),
        (6, long_text + " end", "en", "a"),
        (7, "word", None, None),
        (8, "Word", "fr", "c"),
        (9, "12345 !!! ???", "fr", "c"),
        (10, "un deux trois quatre cinq six sept huit", "fr", "c"),
    ]
    return spark.createDataFrame([(i, t, lang, s, None if t is None else len(t), 7, "k", "b", 3, 0.5, 9, 11) for i, t, lang, s in rows], SCHEMA)


def no_documents(spark):
    return spark.createDataFrame([], SCHEMA)


def near_copies(rng: random.Random, base: list[str], n: int, edits: int) -> list[str]:
    out = []
    for _ in range(n):
        own = list(base)
        for at in rng.sample(range(len(own)), edits):
            own[at] = "".join(rng.choice("klmnop") for _ in range(5))
        out.append(" ".join(own))
    return out
