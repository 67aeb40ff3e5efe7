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


@pytest.fixture(scope="session")
def documents(spark):
    """documents(rows): (doc_id, text) or (doc_id, text, lang, source), on a few partitions."""

    def make(rows, parts=3):
        full = [(*r, *[None] * (4 - len(r)), None if r[1] is None else len(r[1])) for r in rows]
        return spark.createDataFrame(full, DOCUMENTS).repartition(parts)

    return make


@pytest.fixture(scope="session")
def clashing(spark):
    """Adds columns whose names an operator might use itself."""
    from pyspark.sql import functions as F

    def add(df):
        names = "w bits marks found size copies rank hash place sig rep n text_a row carried position key".split()
        return df.select("*", *[F.lit(i).alias(c) for i, c in enumerate(names) if c not in df.columns])

    return add
