import pytest


@pytest.fixture(scope="session")
def documents(spark):
    """Rows with nulls, blanks, repeats, ties and columns whose names clash with those used inside."""
    line = "the quick brown fox jumps over the lazy dog near the old river bank today"
    rows = [
        (1, line, "en"), (2, line, "en"), (2, line, "en"), (3, None, "en"), (4, "", None), (5, "   \n\t ", "en"),
        (None, line + "\n" + line, "de"), (6, "one", "de"), (7, "word " * 30_000, "en"), (8, line + "\nshort line\n\n", "en"),
        (9, "Ähnlich ist das schöne Wetter über den hohen Bergen heute nicht", "de"), (10, "12 % !!", None),
    ]
    schema = "doc_id long, text string, lang string, label int, print long, class long, n long, tokens string"
    return spark.createDataFrame([(*r, 0, 0, 0, 0, "x") for r in rows], schema)


@pytest.fixture(scope="session")
def nothing(documents):
    return documents.limit(0)


@pytest.fixture(scope="session")
def labels(spark):
    rows = [(i, int(i % 2 == 0), int(i % 3 == 0)) for i in range(1, 11)] + [(None, 1, 1), (1, None, None), (2, 1, 0)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
