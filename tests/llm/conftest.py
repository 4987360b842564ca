import pytest
from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                     T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
                     # extra columns whose names the operators use themselves
                     T.StructField("fp", T.StringType()), T.StructField("key", T.StringType()), T.StructField("kept", T.StringType()),
                     T.StructField("n_rows", T.StringType()), T.StructField("text_key", T.StringType()), T.StructField("share", T.StringType()),
                     T.StructField("epoch", T.StringType()), T.StructField("spans", T.StringType()), T.StructField("host", T.StringType())])

LONG = " ".join(f"w{i % 977}x{i}" for i in range(60_000))


def documents(spark, rows):
    """Rows of (doc_id, text[, lang, source]) with the clashing extra columns."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "src1", len(r[1] or "")) + ("x",) * 9 for r in rows]
    return spark.createDataFrame(full, DOCS)


EDGE_ROWS = [
    (1, "The quick brown fox jumps over the lazy dog near the river bank today"), (2, "The quick brown fox jumps over the lazy dog near the river bank today"),
    (2, "The quick brown fox jumps over the lazy dog near the river bank today"), (3, None), (4, ""), (None, "a text without an id"),
    (None, None), (5, "two words", None, None), (6, "  \n\t "), (7, LONG, "de", "src0"), (7, LONG, "de", "src0"), (8, "!!! ??? 123", None, "src2"),
    (9, "a text without an id", "fr", None), (10, "éà ß ñ 漢字 кириллица " * 5, "fr", "src7"),
]


@pytest.fixture
def edge_docs(spark):
    return documents(spark, EDGE_ROWS)


@pytest.fixture
def no_docs(spark):
    return documents(spark, [])
