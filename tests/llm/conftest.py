from __future__ import annotations

import pytest
from pyspark.sql import types as T

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("chunk", T.StringType()),
        T.StructField("ids", T.StringType()),
        T.StructField("node", T.StringType()),
    ]
)


@pytest.fixture(scope="session")
def documents(spark):
    """Builds documents from texts; further columns bear names that operators use inside."""

    def build(texts, first=0, lang="en"):
        rows = [(first + i, t, lang, "c", "i", "n") for i, t in enumerate(texts)]
        return spark.createDataFrame(rows, DOCS)

    return build


@pytest.fixture(scope="session")
def corpus(root):
    """Whole texts of the small table, by id."""
    import pyarrow.parquet as pq

    table = pq.read_table(f"{root}/documents.parquet").to_pydict()
    return dict(zip(table["doc_id"], table["text"], strict=True))
