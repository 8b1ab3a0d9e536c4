"""Pipeline stages: ``(spark, docs, sf_dir)`` to the rows that go on.

All but the last return the columns of ``documents`` as they came (other columns go along).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from servelens.llm.queries import WORD_BPE, vocabulary


def keep_good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, fitted on these documents, does not reject."""
    from servelens.llm.quality import keep_good

    return keep_good(docs, train_rows=8000, size=2048, threshold=0.5)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component: the one of smallest id."""
    from servelens.llm.simhash import keep_one_per_group

    return keep_one_per_group(docs, shingle=4, max_distance=4, seed=42)


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by its kind in brackets; ``n_chars`` follows the new text (NULL stays NULL)."""
    from servelens.llm.pii import redacted

    out = docs.withColumn("text", redacted(F.col("text")))
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix to the source weights takes them."""
    from servelens.llm.mixing import mixed_documents

    return mixed_documents(docs, weights=(5, 2, 1), max_copies=3)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the remaining documents, each copy packed."""
    from servelens.llm.packing import pack

    return pack(docs, vocabulary(WORD_BPE), end_id=1, seq_len=2048)
