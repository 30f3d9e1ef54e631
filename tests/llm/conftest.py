import os
import sys

import pytest
from pyspark.sql import types as T

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

# The columns of documents and some that clash with names the operators use inside.
SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType()),
    *(T.StructField(name, T.LongType()) for name in
      ("size", "shard", "slot", "score", "words", "lines", "md5", "key", "weight", "set_id", "blob", "fails", "id"))])


@pytest.fixture()
def documents(spark):
    """documents(rows): rows of (doc_id, text[, source]) as a table with clashing extra columns."""
    def made(rows):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or "")) + (7,) * (len(SCHEMA) - 5)
                for r in rows]
        return spark.createDataFrame(full, SCHEMA).coalesce(2)  # few Python workers
    return made

