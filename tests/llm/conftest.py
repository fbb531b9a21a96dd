import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tests_llm_phrase import phrase  # noqa: E402

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"

ODD = [
    (1, phrase(1, 60), "en", "s", 1),
    (1, phrase(1, 60), "en", "s", 1),        # a repeated row
    (2, phrase(1, 60).upper(), None, "s", 2),
    (3, None, "de", None, None),
    (4, "", None, "s", 0),
    (5, "", "en", "t", 0),
    (None, phrase(2, 50), "en", "s", 5),
    (None, phrase(2, 50), None, "s", 5),
    (6, phrase(3, 30_000), "fr", "t", 6),    # very long
    (7, "ab \u00e9\u4e2d\U0001f600", "en", "t", 7),
    (8, "one two", "en", "t", 8),
    (9, "!!! ???", "en", "t", 9),
    (10, phrase(2, 48) + " other end", "en", "t", 9),
]


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty and very long texts, repeated rows, null ids, and columns whose names clash with results."""
    docs = spark.createDataFrame(ODD, SCHEMA)
    clashing = ("id", "hit", "row", "score", "digest", "component", "shard", "slot", "n", "key", "found", "h", "N_words", "label")
    return docs.selectExpr("*", *[f"doc_id AS `{c}`" for c in clashing])


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)
