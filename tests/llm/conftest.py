import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

LONG = " ".join(f"word{i % 700} other{i % 13}" for i in range(30_000))
#: (doc_id, text, lang, source): missing values, empty and white texts, ties, repeats, a long text
ODD_ROWS = [
    (1, "the quick brown fox jumps over the lazy dog again and again today", "en", "a"),
    (2, "the quick brown fox jumps over the lazy dog again and again today", "en", "b"),
    (2, "the quick brown fox jumps over the lazy dog again and again today", "en", "b"),
    (3, None, "en", "a"),
    (4, "", None, None),
    (5, " \t\n ", "en", "c"),
    (None, "no identifier here but words", "en", None),
    (6, "word", "en", "a"),
    (7, "two words", "en", "a"),
    (8, LONG, "en", "c"),
    (9, "Ünïcödé ΣΑΣ   x́ <|endoftext|> <|startoftext|> ab", "xx", "c"),
]
SCHEMA = "doc_id long, text string, lang string, source string"


@pytest.fixture(scope="session")
def odd(spark):
    """The rows above with extra columns whose names the operators use themselves."""
    extra = "size long, n long, word string, part int, shard string, row long, gid long, _hash long"
    rows = [(*r, 1, 2, "w", 3, "s", 4, 5, 6) for r in ODD_ROWS]
    return spark.createDataFrame(rows, f"{SCHEMA}, {extra}").repartition(3)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
