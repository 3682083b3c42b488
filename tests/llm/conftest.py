from __future__ import annotations

import pytest
from pyspark.sql import types as T

SF = "/root/testdata/sf0.001"
DOCUMENTS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)


@pytest.fixture(scope="session")
def sf_docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture
def documents(spark):
    """Build documents from (doc_id, text) or (doc_id, text, source)."""

    def build(*rows):
        full = [
            (r[0], r[1], "en", r[2] if len(r) > 2 else "s", None if r[1] is None else len(r[1]))
            for r in rows
        ]
        return spark.createDataFrame(full, DOCUMENTS)

    return build
