"""Small fixtures for the text operators."""

from pyspark.sql import Row
from pyspark.sql import functions as F  # noqa: F401
from pyspark.sql import types as T

SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
])

EDGE_TEXTS = [None, "", " ", "\n\n", "a", "same words here", "same words here", "ß ñ é 漢字 🙂 \x1c x\x1dy", "<|endoftext|> a  <|endoftext|>b",
              "tab\tand  two   spaces\r\n", "word " * 5000, "x" * 5000, "it's I'll 'S 12 345", "Line one.\nLine two.\n\nLine one."]


def frame(spark, texts, sources=None, ids=None):
    ids = ids or list(range(len(texts)))
    sources = sources or ["s"] * len(texts)
    return spark.createDataFrame([(i, t, "en", s, None if t is None else len(t)) for i, t, s in zip(ids, texts, sources)], SCHEMA)


def edge(spark):
    """NULLs in every column, repeated rows, empty and long texts."""
    df = frame(spark, EDGE_TEXTS)
    return df.union(spark.createDataFrame([(None, None, None, None, None), (None, "null id", None, None, 3), (5, "same words here", "en", "s", 15)], SCHEMA))


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def fixture_docs(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


def rows(df) -> list[Row]:
    return df.collect()
