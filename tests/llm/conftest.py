import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def odd_docs(spark):
    """Nulls in every column, empty and long texts, ties, repeated rows, and columns whose names clash."""
    long_text = " ".join(f"word{i % 977}" for i in range(12_000))
    rows = [
        (1, None, "en", "a", 0),
        (2, "", "en", None, 0),
        (3, "Same text here", None, "a", 14),
        (4, "same TEXT here", "en", "a", 14),
        (4, "same TEXT here", "en", "a", 14),
        (None, "same text here", "en", "b", None),
        (None, None, None, None, None),
        (7, long_text, "en", "b", len(long_text)),
        (8, "\n\n \n", "en", "b", 4),
        (9, "x" * 50_000, "en", "b", 50_000),
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    clash = ["shard", "slot", "copy", "position", "h", "n", "row", "host", "norm", "kept", "count", "x", "score", "_vp"]
    for name in clash:
        from pyspark.sql import functions as F

        df = df.withColumn(name, F.lit("clash"))
    return df


@pytest.fixture
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
