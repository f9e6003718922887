import pytest


@pytest.fixture(scope="session")
def documents(spark):
    """Rows with every oddity: nulls, empty and very long texts, ties, repeated rows, clashing extra columns."""
    long = "Ein sehr langer Satz, und noch einer. " * 4000
    rows = [
        (1, "the quick brown fox jumps over the lazy dog.", "en", "a", 1), (2, "the quick brown fox jumps over the lazy dog.", "en", "b", 1),
        (2, "the quick brown fox jumps over the lazy dog.", "en", "b", 1), (3, None, None, None, None), (4, "", "en", None, 0),
        (None, "no id at all, but some words", "en", "a", 5), (None, None, None, "a", 5), (5, long, "de", "b", 9), (6, long, "de", "c", 9),
        (7, "123 456 !!!", None, "c", 1), (7, "other text with the same id", "en", "c", 1), (8, " \n\t ", "fr", "d", 2),
        (9, "İstanbul ΣΑΣ é 日本語 \x00 x", "xx", "é", 2), (10, "the quick brown fox jumps over the lazy cat.", "en", "b", 1),
    ]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, size int").selectExpr(
        "*", "size AS kept", "size AS start", "lang AS _text", "size AS whole", "size AS fingerprint", "lang AS __id", "lang AS __text", "size AS __words", "size AS __times", "lang AS _own_id", "lang AS _own_text"
    )


@pytest.fixture(scope="session")
def no_documents(documents):
    return documents.where("false")
