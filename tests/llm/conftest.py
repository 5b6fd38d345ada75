import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

PARA = "the quick brown fox jumps over the lazy dog near the old stone bridge while seven small birds watch from a tall tree "
DOCS = [
    (1, PARA * 3 + "one", "en", "a"),
    (2, PARA * 3 + "one", "en", "a"),
    (3, (PARA * 2 + " ".join(f"w{i}" for i in range(60))), "en", "a"),
    (4, (PARA * 2 + " ".join(f"w{i}" for i in range(59)) + " x"), "en", None),
    (5, None, "en", "b"),
    (6, "", None, "b"),
    (7, " \t\n ", "en", "b"),
    (8, "Hi", "en", "b"),
    (9, "hi", "de", "c"),
    (10, "1234 5678", "en", "c"),
    (11, "日本語 テキスト 漢字", None, "c"),
    (12, "wide space　here and nbsp <|endoftext|> 's it's", "en", "c"),
    (13, "a " * 5000 + "\n" + "line of text\n" * 400, "en", "a"),
    (14, "same line here\nsame line here\nother # line * $\n", "en", "a"),
    (15, "x" * 20000, "en", None),
    (None, "a row without an id at all", "en", "a"),
    (16, "repeated row of text with some words in it", "en", "a"),
    (16, "repeated row of text with some words in it", "en", "a"),
]


@pytest.fixture(scope="session")
def docs(spark):
    """Nulls, empty and long texts, ties, repeated rows, and columns named like results."""
    schema = "doc_id long, text string, lang string, source string, n_chars long, score string, Size string, kept int"
    rows = [(i, t, lang, source, len(t or ""), "s", "z", 1) for i, t, lang, source in DOCS]
    return spark.createDataFrame(rows, schema).repartition(5)


@pytest.fixture(scope="session")
def rows():
    return DOCS
