import pytest
from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                     T.StructField("n_chars", T.LongType())])


@pytest.fixture(scope="session")
def docs_of(spark):
    """Builds a documents table from (doc_id, text) or longer rows, with extra columns of clashing names."""
    def build(rows, clash=("score_", "hits_", "kept", "node", "n")):
        full = [(r[0], r[1], *(r[2:4] if len(r) > 3 else ("en", "s1")), None if r[1] is None else len(r[1])) for r in rows]
        df = spark.createDataFrame(full, DOCS)
        for c in clash:
            df = df.selectExpr("*", f"'x' as `{c}`")
        return df
    return build
