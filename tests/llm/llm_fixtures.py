import pytest


@pytest.fixture
def docs(spark):
    """A function that makes a documents frame from (doc_id, text) pairs, with
    columns whose names an operator might use itself."""
    def make(rows):
        return spark.createDataFrame(
            [(i, t, "xx", "s", 0, 7, 8) for i, t in rows],
            "doc_id long, text string, lang string, source string, n_chars long, "
            "n_words long, node long")
    return make
