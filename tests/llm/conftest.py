import pytest

LONG = "word " * 30_000


@pytest.fixture(scope="session")
def docs(spark):
    """Makes a documents table: rows of (doc_id, text), with extra columns of clashing names."""
    from pyspark.sql import functions as F

    def make(rows):
        df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n_chars", F.length("text").cast("long"))
        for c in ("id", "fp", "row", "key", "body", "n", "label", "cell", "start", "_text", "base", "mark", "y"):
            df = df.withColumn(c, F.lit("clash"))
        return df
    return make
