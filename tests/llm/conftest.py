import pytest

LONG = "word " * 60_000


@pytest.fixture(scope="session")
def odd_rows():
    """Documents with null ids and texts, empty and long texts, ties and repeated rows, and
    extra columns named like those inside the operators."""
    return [
        (1, "a b c d e f g h", "en", "s", 8, "x", 1),
        (1, "a b c d e f g h", "en", "s", 8, "x", 1),
        (2, "a b c d e f g h", None, None, None, None, None),
        (None, "a b c d e f g h", "en", "s", 8, "y", 2),
        (None, None, None, None, None, None, None),
        (3, None, "en", "s", 0, "z", 3),
        (4, "", "de", "t", 0, "z", 3),
        (5, " \t\n ", "de", "t", 4, "z", 3),
        (6, LONG, "de", "t", len(LONG), "z", 3),
        (7, "é" * 5000, "fr", "t", 5000, "z", 3),
    ]


SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, _h string, score int"


@pytest.fixture
def odd(spark, odd_rows):
    return spark.createDataFrame(odd_rows, SCHEMA)


@pytest.fixture
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture
def table_of(spark):
    """A documents table of these texts, ids from 0."""
    def make(texts, **more):
        rows = [(i, t, "en", "s", len(t or ""), None, None) for i, t in enumerate(texts)]
        return spark.createDataFrame(rows, SCHEMA)

    return make
