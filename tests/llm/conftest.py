from __future__ import annotations

import pytest

from tests.llm.helpers import EDGE, EXTRA


@pytest.fixture(scope="session")
def edge_docs(spark):
    from pyspark.sql import functions as F
    df = spark.createDataFrame(EDGE, "doc_id long, text string, lang string, source string, n_chars long")
    return df.select("*", *[F.lit(f"own {c}").alias(c) for c in EXTRA])


@pytest.fixture(scope="session")
def empty_docs(edge_docs):
    return edge_docs.limit(0)
