import pytest

from stocktrail.llm.queries import findable

DOCS = "doc_id long, text string, lang string, source string, n_chars long, component_id string, size string"


@pytest.fixture(autouse=True)
def workers_find_the_package(spark):
    findable(spark)


@pytest.fixture
def table(spark):
    """Rows (doc_id, text, lang, source) as a table with columns whose names clash with results."""

    def make(rows):
        full = [(*r, None, None, "en", "a")[: len(r)] if len(r) > 3 else (*r, *("en", "a")[len(r) - 2 :]) for r in rows]
        return spark.createDataFrame([(*r, len(r[1] or ""), "x", "y") for r in full], DOCS)

    return make
