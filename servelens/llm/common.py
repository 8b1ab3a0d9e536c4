"""Helpers shared by the text operators."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from servelens.session import ensure_checkpoint_dir

#: white space and words as all operators here define them (fixed by the result contracts)
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def shared_path(spark: SparkSession, name: str) -> str:
    """A new folder name below the checkpoint folder that all executors share."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write once to the shared folder and read back: later stages neither recompute the
    rows nor lose them with an executor."""
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fenced(df: DataFrame) -> DataFrame:
    """The same rows behind a generator: a later filter on a computed column is not rewritten into the
    expressions below, which would evaluate arrays again inside lambdas."""
    return df.select(F.explode(F.array(F.struct(*df.columns))).alias("r")).select("r.*")


def occurrences(text: Column, characters: str) -> Column:
    """How often any of the (one-byte) characters occurs."""
    n = F.octet_length(text)
    return sum((n - F.octet_length(F.replace(text, F.lit(c), F.lit(""))) for c in characters[1:]),
               n - F.octet_length(F.replace(text, F.lit(characters[0]), F.lit(""))))


def slices(lengths, limit: int) -> Iterator[tuple[int, int]]:
    """Row ranges of a batch whose summed lengths stay near ``limit`` (a longer row stands alone)."""
    start, total = 0, 0
    for i, n in enumerate(lengths):
        if i > start and total + n > limit:
            yield start, i
            start, total = i, 0
        total += n
    if len(lengths) > start:
        yield start, len(lengths)


def column_slices(batch, column: str, limit: int = 2 << 20) -> Iterator[tuple[int, object]]:
    """``(first row, Arrow array)`` of a text column of an Arrow batch in bounded pieces.

    After the last piece the memory that Arrow's pool keeps for reuse goes back to the system: else a
    Python worker stays as large as its largest batch made it, through all later stages.
    """
    import pyarrow as pa
    import pyarrow.compute as pc

    texts = batch.column(batch.schema.get_field_index(column))
    for a, b in slices(pc.fill_null(pc.binary_length(texts), 0).to_pylist(), limit):
        yield a, texts.slice(a, b - a)
    pa.default_memory_pool().release_unused()


def text_slices(batch, column: str, limit: int = 1 << 20) -> Iterator[tuple[int, int, list]]:
    """``(first row, end row, texts)`` of an Arrow batch in bounded pieces; NULL texts come empty."""
    for a, texts in column_slices(batch, column, limit):
        none = "" if texts.type == "string" else b""
        yield a, a + len(texts), [none if t is None else t for t in texts.to_pylist()]
