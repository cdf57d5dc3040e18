import pytest

TABLE = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def table(spark):
    """Rows of documents from texts, ids from 0."""

    def make(texts, langs=None):
        return spark.createDataFrame([(i, t, (langs or ["en"] * len(texts))[i], "s", len(t or "")) for i, t in enumerate(texts)], TABLE)

    return make
