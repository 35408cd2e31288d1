import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)


@pytest.fixture(scope="session")
def corpus(spark):
    """Make a documents table from (doc_id, text) or (doc_id, text, lang, source) rows."""

    def make(rows, extra=None):
        full = [(*r, *[None, None, None][len(r) - 2 :])[:4] for r in rows]
        frame = spark.createDataFrame([(*r, len(r[1]) if r[1] else 0) for r in full], SCHEMA)
        for name in [*(extra or ()), *(["odd name-1.x"] if extra else [])]:
            frame = frame.withColumn(name, F.lit("x"))
        return frame

    return make


@pytest.fixture(scope="session")
def documents(spark, data):
    return spark.read.parquet(f"{data}/documents.parquet")


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls, empty and very long texts, ties and repeated rows."""
    return [
        (None, None),
        (None, "words without an id stand here for the test of nulls"),
        (1, None),
        (2, ""),
        (3, " \t\n "),
        (4, "one"),
        (5, "one"),
        (5, "one"),
        (6, "x" * 50_000),
        (7, " ".join(f"w{i % 977}" for i in range(30_000))),
        (8, "é ß 你好 \U0001f600   a\u0085b"),
    ]
