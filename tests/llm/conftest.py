import pytest
from hypothesis import settings
from pyspark.sql import functions as F

# A busy machine makes no example wrong.
settings.register_profile("no_deadline", deadline=None)
settings.load_profile("no_deadline")


@pytest.fixture
def documents(spark):
    """Table of documents with columns that clash with those of the operators."""

    def build(rows, extra=True):
        docs = spark.createDataFrame(rows, "doc_id long, text string")
        if extra:
            for name in ("n", "start", "node", "bucket", "anchor", "run", "length", "text_hash", "window_id"):
                docs = docs.withColumn(name, F.lit("own"))
        return docs

    return build
