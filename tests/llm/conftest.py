from __future__ import annotations

import pytest

#: Null, empty, blank, short, repeated and very long texts; equal and null ids; columns
#: whose names the operators use themselves.
AWKWARD = [
    (1, None, None, None, "x"),
    (2, "", "en", "a", "x"),
    (3, " \t\n\x0b\x0c\r", "en", "a", "x"),
    (4, "word", "en", "a", None),
    (5, "the same line\nthe same line\nother words here", "en", "a", "x"),
    (5, "the same line\nthe same line\nother words here", "en", "a", "x"),
    (None, "a text without an id, twice", "de", None, "x"),
    (None, "a text without an id, twice", "de", None, "x"),
    (6, "one two three four " * 30_000, "fr", "b", "x"),
    (7, "ÀÉ ü ß 漢字 🙂 <|endoftext|> " * 20, "de", "b", "x"),
    (8, "12 34 !! ??", "en", "b", "x"),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars string, row string, key string, id string, shard string, size string, _text string, n string"


@pytest.fixture(scope="session")
def awkward(spark):
    rows = [(*r, "r", "k", "i", "s", "z", "t", "n") for r in AWKWARD]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)
