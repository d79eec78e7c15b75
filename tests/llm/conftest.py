import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def make_docs(spark):
    """Rows (doc_id, text) as a documents table."""
    def make(rows, lang="en"):
        return spark.createDataFrame([(i, t, lang, "s", None if t is None else len(t)) for i, t in rows], DOCS)
    return make


@pytest.fixture(scope="session")
def sample(spark):
    """The small documents table, whole, as Spark rows and as Python rows."""
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    return df, df.collect()
