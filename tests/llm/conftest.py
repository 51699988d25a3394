import pytest
from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])


@pytest.fixture(scope="session")
def documents(spark):
    """(id, text, source) -> documents."""

    def make(rows):
        return spark.createDataFrame([(r[0], r[1], "en", r[2] if len(r) > 2 else "s", None if r[1] is None else len(r[1])) for r in rows], DOCS)

    return make


@pytest.fixture(scope="session")
def clashing():
    """The same rows with columns whose names differ by case only, or are the operators' own."""
    from pyspark.sql import functions as F

    def make(df):
        return df.select("*", *[F.lit(i).alias(n) for i, n in enumerate(("Text", "DOC_ID", "row", "node", "shard", "score", "hit", "block", "k"))])

    return make
