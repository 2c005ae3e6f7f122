import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def docs(spark):
    """documents with nulls in every column, empty, white and repeated rows."""

    def make(*texts, extra=True):
        rows = [(i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)]
        if extra:
            rows += [(None, "an id is missing here", None, None, None), (900, None, None, None, None), (901, "", "en", "s", 0), (902, " \n\t ", "en", "s", 4), (903, "same row twice", "en", "s", 14), (903, "same row twice", "en", "s", 14)]
        return spark.createDataFrame(rows, DOCS)

    return make


@pytest.fixture
def clashing():
    """A frame with columns named like those that operators add."""
    from pyspark.sql import functions as F

    def make(df):
        return df.withColumns({n: F.lit("x") for n in ("score", "kept", "n_words", "host", "path", "rule", "start", "y", "ids", "label", "n", "row", "key", "tid", "class_id", "licence", "found")})

    return make
