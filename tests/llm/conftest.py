import pytest

DOCUMENT = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def odd_documents(spark):
    """Null, empty, blank, repeated and long texts, a null id, and columns named like the operators' own."""
    rows = [
        (1, None, "en", "a", None), (2, "", "en", "a", 0), (3, " \n\t ", None, "a", 4), (4, "Same words here again", "en", None, 21),
        (4, "Same words here again", "en", None, 21), (None, "no id at all", "fr", "b", 12), (5, "long word " * 20_000, "de", "b", 200_000), (6, "9 " * 9_000, "de", "b", 18_000),
    ]
    frame = spark.createDataFrame(rows, DOCUMENT)
    return frame.selectExpr("*", "'x' AS print", "1 AS kept", "'y' AS base", "0 AS score", "'z' AS row", "'w' AS word", "2 AS n")
