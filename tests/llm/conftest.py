import pytest
from llm_data import long_text

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty and blank and very long texts, ties and repeated rows."""
    rows = [
        (1, "The quick brown fox jumps over the lazy dog, they said.", "en", "a", 10),
        (1, "The quick brown fox jumps over the lazy dog, they said.", "en", "a", 10),
        (2, None, "en", None, None),
        (3, "", None, "a", 0),
        (4, " \n\t ", "de", "a", 3),
        (None, "A row without a number: password=abcdefgh1", "en", "a", 5),
        (5, long_text(30000), "en", None, 1),
        (6, "x" * 50000, None, "a", 1),
        (7, "12345 67890 !!! ???", "en", "a", 1),
        (None, None, None, None, None),
    ]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)
