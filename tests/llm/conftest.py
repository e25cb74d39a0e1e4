from __future__ import annotations

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, _of string, SIZE int, _m string"
LONG = " ".join(f"w{i % 977}x{i * i % 613}" for i in range(60_000))


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty and long texts, repeated rows and ids, and columns whose names clash."""
    prose = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen"
    rows = [
        (1, prose, "en", "a", 1, "x", 1, "m"), (1, prose, "en", "a", 1, "x", 1, "m"), (2, None, "en", "a", None, None, None, None),
        (3, "", None, None, 0, "", 0, ""), (None, prose, "en", None, None, None, None, None), (4, LONG, None, "b", 9, "y", 2, "m"),
        (5, LONG + " end", "en", "b", 9, "y", 2, "m"), (6, " \t\n\x0b\x0c\r ", "fr", "b", 1, None, 3, "m"),
        (None, None, None, None, None, None, None, None), (7, "ß é ñ   \x1c漢字 \U0001f600", "de", "c", 8, "z", 4, "m"),
        (7, "another text under the same id", "de", "c", 8, "z", 4, "m"), (-8, prose.upper(), "en", "a", 1, "x", 1, "m"),
    ]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
