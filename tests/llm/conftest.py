import os
import sys

import pytest
from pyspark.sql import types as T

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tests_llm_words import words  # noqa: E402

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
# names that the operators use themselves
CLASHING = ["row", "block", "kept", "size", "bands", "n_words", "text_key", "m", "keep", "start"]


@pytest.fixture(scope="session")
def docs_of(spark):
    """Rows of (doc_id, text[, source]) as a documents table with extra columns of clashing names."""

    def make(rows, partitions=3):
        filled = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or ""), *[f"{c} of {r[0]}" for c in CLASHING]) for r in rows]
        shape = T._parse_datatype_string(DOCS + "".join(f", {c} string" for c in CLASHING))
        return spark.createDataFrame(filled, shape).repartition(partitions)

    return make


@pytest.fixture(scope="session")
def odd_rows():
    """NULLs, empty and long texts, ties, repeated rows, one id with two texts, white space of other kinds."""
    long = " ".join(words(1, 20_000, 5_000))
    plain = " ".join(words(2, 120))
    lines = "\n".join(" ".join(words(k, 12)) for k in range(8))
    return [
        (1, plain), (2, None), (3, ""), (4, "   \t\n\x0b "), (5, long), (6, plain), (7, lines), (7, lines), (8, lines + "\nextra line of text here"),
        (None, "a text without an id"), (None, plain), (9, "one"), (9, "two words"), (10, "Ünïcode stays one wörd \x1f x"),
        (-3, "negative id " * 30), (11, plain.upper()), (12, "word " * 2_000),
    ]
