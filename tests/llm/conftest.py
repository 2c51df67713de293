import pytest
from pyspark.sql import types as T

DOC = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                    # names that operators use inside
                    T.StructField("n", T.StringType()), T.StructField("node", T.StringType()), T.StructField("size", T.StringType()),
                    T.StructField("bucket", T.StringType()), T.StructField("base", T.StringType())])


@pytest.fixture()
def documents(spark):
    """Make a documents table from (doc_id, text[, lang[, source]]) with extra columns of clashing names."""
    def make(rows):
        full = [(*r, *[None] * (4 - len(r)), "x", "y", None, "z", "w") for r in rows]
        return spark.createDataFrame(full, DOC)
    return make


@pytest.fixture()
def vectors(spark):
    schema = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())),
                           T.StructField("label", T.IntegerType()), T.StructField("rep", T.StringType()), T.StructField("dim", T.StringType())])
    return lambda rows: spark.createDataFrame([(i, v, 0, "x", None) for i, v in rows], schema)
