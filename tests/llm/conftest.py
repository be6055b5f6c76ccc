import pytest

CLASH = "doc_id long, text string, n long, row string, score string, spans string, n_words int, uid long, lang string"


@pytest.fixture
def make(spark):
    """Documents with extra columns whose names clash with inner ones."""

    def build(texts, ids=None, lang="en"):
        ids = list(range(len(texts))) if ids is None else ids
        rows = [(i, t, 1, "r", "s", "p", 2, 3, lang) for i, t in zip(ids, texts)]
        return spark.createDataFrame(rows, CLASH)

    return build
