import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture()
def docs(spark):
    """Documents from (doc_id, text) or whole rows."""
    def make(rows, extra=()):
        full = [(*r, *("en", "src", len(r[1] or ""))[:5 - len(r)]) if len(r) < 5 else r for r in rows]
        return spark.createDataFrame(full, DOCS)
    return make


def words(rng, n, vocabulary=400):
    return [f"w{int(x)}" for x in rng.integers(0, vocabulary, n)]


@pytest.fixture()
def make_words():
    return words
