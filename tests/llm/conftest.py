import pytest
from pyspark.sql import functions as F


@pytest.fixture
def documents(spark):
    """A documents table from (doc_id, text[, lang[, source]]) rows, with a column that clashes with results."""

    def build(rows):
        rows = [(*r, *[None] * (4 - len(r))) for r in rows]
        df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
        return df.withColumn("n_chars", F.length("text").cast("long")).withColumn("score", F.lit("x")).withColumn("shard", F.lit("y"))

    return build
