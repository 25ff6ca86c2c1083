import os
import sys

import pytest
from pyspark.sql import SparkSession, types as T

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
])


@pytest.fixture
def docs(spark: SparkSession):
    """docs(text, ...) or docs((id, text), ...) -> a documents table."""
    from seriesmart.llm.staging import ship

    ship(spark)

    def build(*rows):
        pairs = [r if isinstance(r, tuple) else (i, r) for i, r in enumerate(rows)]
        full = [(i, t, "en", "src", None if t is None else len(t)) for i, t in pairs]
        return spark.createDataFrame(full, DOCS).repartition(3)

    return build
