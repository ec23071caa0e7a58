import pytest


@pytest.fixture(scope="session")
def odd(spark):
    """Documents with nulls, empty and long texts, repeated rows, ties and clashing columns."""
    long = " ".join(f"word{i % 700} Straße {i}" for i in range(30_000))
    rows = [
        (1, "the quick brown fox jumps over the lazy dog", "en", 1, "a"),
        (1, "the quick brown fox jumps over the lazy dog", "en", 1, "a"),
        (2, "THE quick brown fox jumps over the lazy dog", "en", 2, None),
        (3, "", "en", 3, "b"), (4, None, "de", 4, "c"), (None, "ohne Nummer aber mit Text", "de", 5, "d"),
        (5, long, "de", 6, "e"), (6, "12 34 !!", None, 7, "f"), (7, " \n\t ", "fr", 8, "g"),
        (8, "eins", None, None, "h"),
    ]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, score long, `_id` string")


@pytest.fixture(scope="session")
def nothing(odd):
    return odd.limit(0)
