import pytest


@pytest.fixture(scope="session")
def odd(spark):
    """Documents with nulls everywhere, an empty and a long text, repeated rows and clashing columns."""
    rows = [
        (None, None, None, None), (1, "", "en", "x"), (2, None, "en", None), (3, "!!! ???", None, "x"),
        (4, "the cat sat on the mat and the dog sat on the log today", "en", "y"),
        (4, "the cat sat on the mat and the dog sat on the log today", "en", "y"),
        (5, "The cat sat on the mat, and the dog sat on the log today!", "en", "z"),
        (6, "word " * 30_000, "en", "z"), (None, "ein kurzer Text ohne Nummer", "de", "z"), (7, "a b", "en", "q"),
    ]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, score string")
