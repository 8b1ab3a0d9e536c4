"""Registered queries of this subpackage, with production parameters, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from servelens.llm.common import documents

#: vocabulary files; the second argument of each operator, so any other file may be named
BYTE_BPE, WORD_BPE, PIECES = "byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from servelens.llm.quality import classify
    return classify(documents(spark, sf_dir), train_rows=8000, size=2048, threshold=0.5)


def op2_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    from servelens.llm.syncmers import edited_fingerprints
    return edited_fingerprints(documents(spark, sf_dir), k=5, s=2, sketch=64)


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from servelens.llm.mixing import mix
    return mix(documents(spark, sf_dir), weights=(5, 2, 1), max_copies=3)


def op5_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from servelens.llm.rules import fit, judge
    docs = documents(spark, sf_dir)
    rules = fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), train_rows=10_000)
    return judge(docs, rules).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op4_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    from servelens.llm.html_text import extract
    return extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op6_id_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    from servelens.llm.range_coder import write_and_read
    return write_and_read(documents(spark, sf_dir), vocabulary(BYTE_BPE), end_id=0)


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from servelens.llm.simhash import as_hex, near_duplicates
    found = near_duplicates(documents(spark, sf_dir), shingle=4, max_distance=4, seed=42)
    return found.select("doc_id", as_hex(found["fingerprint"]).alias("fingerprint"), "component_id")


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from servelens.llm.packing import pack
    return pack(documents(spark, sf_dir), vocabulary(WORD_BPE), end_id=1, seq_len=2048)


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    from servelens.llm.pii import pii_digest
    return pii_digest(documents(spark, sf_dir))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from servelens.llm.viterbi import count_tokens
    return count_tokens(documents(spark, sf_dir), vocabulary(PIECES))


def op11_orchard(spark: SparkSession, sf_dir: str) -> DataFrame:
    from servelens.llm.orchard import code_digest
    return code_digest(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), parts=8, entries=16, rounds=6)


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    from servelens.llm.filter_audit import audit
    return audit(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op13_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from servelens.llm.suffix_dedup import without_repeats
    return without_repeats(documents(spark, sf_dir), min_bytes=400)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_quality, op2_fingerprints, op3_mixing, op4_html, op5_rules, op6_id_files, op7_simhash, op8_packing, op9_pii,
                                    op10_token_counts, op11_orchard, op12_filter_audit, op13_suffix_dedup)}


def oracle_sql() -> dict[str, str]:
    from servelens.llm.filter_audit import AUDIT_SQL
    from servelens.llm.orchard import CODES_SQL
    return {"op11_orchard": CODES_SQL, "op12_filter_audit": AUDIT_SQL}
