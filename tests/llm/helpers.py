"""Tables for the operators' tests: edge cases, and columns whose names the operators use inside."""

from __future__ import annotations

import random

CLASHES = ("class", "region", "row", "label_", "part", "n", "size", "bucket", "component", "unit", "tokens", "regions", "before", "op")


def documents(spark, rows):
    """rows: (doc_id, text, lang, source); further columns clash with names inside the operators."""
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in CLASHES)
    return spark.createDataFrame([(i, t, lang, source, None if t is None else len(t), *["x"] * len(CLASHES)) for i, t, lang, source in rows], schema)


def sentence(r: random.Random, n: int, words: int = 400) -> str:
    return " ".join(f"w{r.randrange(words)}" for _ in range(n))


def edge_rows():
    r = random.Random(3)
    long = sentence(r, 60_000, 5000)
    return [
        (1, None, "en", "web"), (2, "", "en", "web"), (3, " \t\n", None, None), (4, "one", "de", "web"), (5, "One", "en", None),
        (6, long, "en", "web"), (7, long, "en", "books"), (8, "x" * 200_000, "en", "web"), (9, "a b c d e f", None, "web"),
        (9, "a b c d e f", None, "web"), (10, "  été \U0001f600 café", "fr", "web"), (11, sentence(r, 80), "en", "web"), (12, sentence(r, 80), "en", "web"),
    ]
