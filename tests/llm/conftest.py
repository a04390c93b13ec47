import pytest


@pytest.fixture(scope="session")
def docs_of(spark):
    """A documents table from (doc_id, text) pairs, with a clashing extra column."""
    def make(rows, extra=True):
        full = [(d, t, "en", "src0", "x", 1) for d, t in rows]
        df = spark.createDataFrame(full, "doc_id long, text string, lang string, source string, "
                                         "row_key string, line int")
        return df if extra else df.drop("row_key", "line")
    return make
