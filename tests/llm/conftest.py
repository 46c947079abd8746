import pytest
from brute import prose, texts

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size long, fp string, __x int, key string"


@pytest.fixture(scope="session")
def odd_rows():
    """Null ids and texts, empty and long texts, copies, near copies, ties, repeated rows, clashing columns."""
    rows = [(i, t, "en" if i % 3 else None, f"s{i % 4}" if i % 5 else None, len(t or ""), i, "f", 1, "k")
            for i, t in enumerate(texts())]
    return [*rows, rows[3], (None, prose(9, 70), "en", "s1", 1, 1, "f", 1, "k")]


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    return spark.createDataFrame(odd_rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
