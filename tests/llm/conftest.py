import pytest

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, size long, node long, root string, copies int, line int, digest string, score double"
LONG = "alpha beta gamma delta epsilon " * 8_000


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty, wordless and long texts, repeated rows, clashing names."""
    extra = (0, 0, "r", 1, 1, "d", 0.5)
    rows = [
        (1, None, "en", "s", None, *extra),
        (2, "", None, None, 0, *extra),
        (3, "!!! ... ???", "en", "s", 11, *extra),
        (None, "a text without an id here", "en", "s", 25, *extra),
        (5, LONG, "en", "t", len(LONG), *extra),
        (5, LONG, "en", "t", len(LONG), *extra),
        (6, "short", "en", None, 5, *extra),
        (7, "Änd\nünïcode 12 \U0001f600 lines\n\n", "de", "t", 20, *extra),
        (8, "x" * 100_000, "en", "t", 100_000, *extra),
        (None, None, None, None, None, None, None, None, None, None, None, None),
    ]
    return spark.createDataFrame(rows, COLUMNS)


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)
