import pytest
from pyspark.sql import types as T

SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)


@pytest.fixture(scope="session")
def docs(spark):
    """Makes a documents table from (id, text) pairs."""

    def make(rows, parts=3):
        full = [(i, t, None, None, None if t is None else len(t)) for i, t in rows]
        return spark.createDataFrame(full, SCHEMA).repartition(parts)

    return make
