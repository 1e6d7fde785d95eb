import pytest

DOC = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def make(spark):
    """A documents table with a clashing extra column, from (id, text) pairs."""
    def table(rows):
        return spark.createDataFrame([(i, t, None, "s", len(t) if t is not None else None, 1) for i, t in rows], DOC + ", _spread int")
    return table
