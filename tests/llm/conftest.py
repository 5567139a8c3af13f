import sys

import pytest
from pyspark.sql import types as T

LONG = "a b " * 60_000

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                     T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])


@pytest.fixture(scope="session")
def docs_of(spark):
    """A documents table from texts (ids 0, 1, ...), or from (id, text) pairs."""
    def make(texts):
        rows = [t if isinstance(t, tuple) else (i, t) for i, t in enumerate(texts)]
        return spark.createDataFrame([(i, t, "en", f"s{i % 3}" if i is not None else None, len(t or "")) for i, t in rows], DOCS)

    return make


@pytest.fixture(scope="session")
def odd(spark, docs_of):
    """Nulls in every column, empty, short and long texts, repeated rows, an extra column with a name the operators use."""
    from pyspark.sql import functions as F

    rows = [(0, None), (1, ""), (2, "   "), (3, "one"), (4, "one two"), (5, LONG), (5, LONG), (6, "ÄÖ ñ \t x y  z"), (6, "other"),
            (None, "null id"), (None, None), (7, "!!! 123")]
    docs = docs_of(rows).union(spark.createDataFrame([(8, "no source", None, None, None)], DOCS))
    for name in ("id", "fp", "row", "raw", "th", "cell", "size", "shard", "grp", "_low"):
        docs = docs.withColumn(name, F.lit("clash"))
    return docs


@pytest.fixture(scope="session")
def empty(docs_of):
    return docs_of([])
