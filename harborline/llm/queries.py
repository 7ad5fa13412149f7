"""The queries op1 to op13 and `pipeline`, with production parameters, over whole tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import filter_audit, html_extract, jaccard_join, licenses, merkle, mixing, packing, pii, quality, token_counts, toxicity, url_filter, vector_neardup
from .common import shared_dir, table


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents enter as one batch, which is then delivered again; the totals by source, language and tokenizer."""
    ledger = token_counts.Ledger(spark, f"{shared_dir(spark)}/harborline-ledger-{uuid.uuid4().hex}")
    for _ in range(2):
        ledger.commit("load", token_counts.counted(table(spark, sf_dir, "documents")).withColumn("op", F.lit("insert")))
    return ledger.totals()


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = quality.rules(table(spark, sf_dir, "documents"))
    return r.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "log_ppl", "ppl_low", "ppl_high")


def op3_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.licenses(table(spark, sf_dir, "documents"), least=0.8)


def op4_vector_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_neardup.near_duplicates(table(spark, sf_dir, "embeddings"), threshold=0.93)


def op5_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op6_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"), url_filter.rule_table(spark))


def op7_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.join(table(spark, sf_dir, "documents"), k=3, percent=90)


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op9_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.personal_data(table(spark, sf_dir, "documents"))


def op10_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.main_text(table(spark, sf_dir, "pages"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.audit(table(spark, sf_dir, "documents"))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def queries() -> dict:
    every = (op1_token_counts, op2_quality_rules, op3_license_scans, op4_vector_near_duplicates, op5_mix_sources, op6_url_filters, op7_ngram_jaccard_join, op8_packing, op9_personal_data, op10_main_text, op11_merkle_manifest, op12_filter_audit, op13_toxicity)
    return {f.__name__: f for f in every}


def oracle_sql() -> dict[str, str]:
    return {"op5_mix_sources": mixing.ORACLE_SQL, "op6_url_filters": url_filter.ORACLE_SQL, "op11_merkle_manifest": merkle.ORACLE_SQL, "op12_filter_audit": filter_audit.ORACLE_SQL}
