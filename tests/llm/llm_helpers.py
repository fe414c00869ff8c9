"""Helpers of the operator tests: small frames with the columns of ``documents``."""

import pytest
from pyspark.sql import types as T

SF = "/root/testdata/sf0.001"
DOCUMENTS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
])
# names that operators use inside
CLASHING = "id fp key n i j c root text_a uid row_key size u words hashes copies h m held_out label".split()


@pytest.fixture(scope="session")
def make_docs(spark):
    """documents frame from (doc_id, text[, source[, lang]]) rows, with extra columns of clashing names."""

    def make(*rows, clashing=False):
        full = [(r[0], r[1], r[3] if len(r) > 3 else "en", r[2] if len(r) > 2 else "s", len(r[1] or "")) for r in rows]
        df = spark.createDataFrame(full, DOCUMENTS)
        if clashing:
            for name in CLASHING:
                df = df.withColumn(name, df["n_chars"])
        return df

    return make


def rows_of(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)
