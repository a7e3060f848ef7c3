import pytest


@pytest.fixture
def documents(spark):
    """A table with nulls, empty and blank texts, ties, repeated rows, and columns with clashing names."""

    def make(rows):
        schema = "doc_id long, text string, lang string, source string, n_chars long, n int, part string, length string, score string, key string"
        full = [(i, t, "en", "s", None if t is None else len(t), 1, "p", "l", "x", "k") for i, t in rows]
        return spark.createDataFrame(full, schema)

    return make
