"""Corpus pipeline over ``documents``: each stage's rows are written and read by the next one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from servelens.llm import stages
from servelens.llm.common import documents, written

STAGES = [
    ("quality", stages.keep_good_quality),
    ("near duplicates", stages.drop_near_duplicates),
    ("personal data", stages.redact_personal_data),
    ("mixing", stages.mix_sources),
    ("packing", stages.pack_sequences),
]

#: tokenizer ids, hash ranks and the learned scorer cannot be written in SQL; the stages are
#: tested against brute force instead
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces of what the stages keep of all documents."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
