import pytest

from pyspark.sql import types as T

DOCUMENT = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
])


@pytest.fixture(scope="session")
def documents(spark):
    def make(rows, parts=3):
        full = [(i, t, lang, "s", None if t is None else len(t)) for i, t, lang in rows]
        return spark.createDataFrame(full, DOCUMENT).repartition(parts)
    return make
