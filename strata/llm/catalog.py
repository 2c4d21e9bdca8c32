"""Queries of the training-data operators, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    cotrain_quality,
    cpsjoin_dedup,
    filter_audit,
    license_scan,
    llr_quality,
    piece_bpe,
    preference_chat,
    record_files,
    skipchain_pii,
    source_divergence,
    subword_langid,
    tree_bpe,
    wu_manber,
)
from .common import table


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents")).drop("found")


def op2_quality_llr(spark: SparkSession, sf_dir: str) -> DataFrame:
    return llr_quality.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_decontaminate_wu_manber(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = wu_manber.scan(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"),
                        (F.col("n_hit") > 0).alias("contaminated"))


def op4_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return record_files.token_files(spark, table(spark, sf_dir, "documents"), digest=True)


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return subword_langid.identify(table(spark, sf_dir, "documents"))


def op6_pii_skipchain(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = skipchain_pii.detect(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", F.sha2("base", 256).alias("base_sha256"), "spans")


def op7_quality_cotraining(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cotrain_quality.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_preference_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = preference_chat.preference_records(table(spark, sf_dir, "conversations"))
    return found.select("pair_id", "n_prompt_turns", "prompt", "chosen", "rejected", preference_chat.spans_text("chosen_mask").alias("chosen_spans"),
                        preference_chat.spans_text("rejected_mask").alias("rejected_spans"), "is_tie")


def op9_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cpsjoin_dedup.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, percent=85)


def op10_bpe_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tree_bpe.round_trip(table(spark, sf_dir, "documents"))


def op11_piece_agenda(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_bpe.digests(table(spark, sf_dir, "documents"))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence.divergence(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (
        op1_license_scan, op2_quality_llr, op3_decontaminate_wu_manber, op4_token_records, op5_language_id, op6_pii_skipchain,
        op7_quality_cotraining, op8_preference_pairs, op9_near_dedup, op10_bpe_tree,
        op11_piece_agenda, op12_filter_audit, op13_source_divergence)}


def oracle_sql() -> dict[str, str]:
    return {"op1_license_scan": license_scan.oracle_sql(), "op3_decontaminate_wu_manber": wu_manber.ORACLE_SQL,
            "op8_preference_pairs": preference_chat.ORACLE_SQL, "op9_near_dedup": cpsjoin_dedup.ORACLE_SQL,
            "op12_filter_audit": filter_audit.ORACLE_SQL, "op13_source_divergence": source_divergence.ORACLE_SQL}
