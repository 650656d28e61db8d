import pytest
from pyspark.sql import types as T

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)


@pytest.fixture(scope="session")
def make_docs(spark):
    """A documents table from (doc_id, text, lang, source) rows."""

    def make(rows):
        filled = [(*row, *[None] * (4 - len(row)))[:4] for row in rows]
        data = [(*row, len(row[1]) if row[1] is not None else None) for row in filled]
        return spark.createDataFrame(data, DOCS)

    return make
