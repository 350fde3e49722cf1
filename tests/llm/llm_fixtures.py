import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, id long, `key` string, block int, n string, words int, h long"


@pytest.fixture(scope="session")
def make(spark):
    """Documents from (doc_id, text[, lang[, source]]), with extra columns whose names clash with internal ones."""
    def build(rows):
        full = [(*r, *("en", "s")[len(r) - 2:], len(r[1] or ""), 5, "k", 1, "n", 2, 3) for r in rows]
        return spark.createDataFrame(full, DOCS)
    return build
