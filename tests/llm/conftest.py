import pytest
from pyspark.sql import types as T

DOCUMENTS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)


@pytest.fixture
def documents(spark):
    """Documents from (doc_id, text) or (doc_id, text, source) rows, over three partitions."""

    def make(*rows, partitions=3):
        full = [(row[0], row[1], None, row[2] if len(row) > 2 else None, None) for row in rows]
        return spark.createDataFrame(full, DOCUMENTS).repartition(partitions)

    return make
