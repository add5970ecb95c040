import pytest
from pyspark.sql import types as T


@pytest.fixture
def documents(spark):
    """Makes a table of documents from (doc_id, text), with a column that clashes with nothing and one that does."""

    def make(rows, extra="fingerprint"):
        schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField(extra, T.StringType())])
        return spark.createDataFrame([(i, t, "x") for i, t in rows], schema)

    return make


EDGES = [(None, None), (None, "a b"), (3, ""), (4, None), (5, "same words here"), (6, "same words here"), (6, "same words here"), (7, "x" * 30_000), (8, "long text of words. " * 3000), (9, "é\n\tü 😀  tail")]


@pytest.fixture
def edges(documents):
    return documents(EDGES)
