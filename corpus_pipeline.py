"""A training-data pipeline over ``documents``: quality rules, near-duplicate
removal, benchmark decontamination, redaction of personal data, tokenization.

Every stage takes (spark, docs, sf_dir) and works on all rows of ``docs``; all but
the last return the columns of ``docs``.  Between stages the rows are written as
Parquet and read again.

Defined cases are those of the operators; in short: null and empty texts fail
the quality rules, repeated rows are copies of which one stays, extra columns
pass through all stages but the last.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import cpsjoin_dedup, llr_quality, skipchain_pii, tree_bpe, wu_manber
from strata.llm.common import prepare, table, text_of
from strata.session import materialize


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules keep."""
    prepare(spark)
    return llr_quality.keep_good(docs, table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (5-word shingles, 0.8)."""
    prepare(spark)
    return cpsjoin_dedup.drop_near_duplicates(docs, shingle=5, percent=80)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of a benchmark item occurs."""
    prepare(spark)
    return wu_manber.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def redact_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by its kind."""
    prepare(spark)
    return skipchain_pii.redact(docs)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, ids, n_tokens, and whether decoding gives the text back."""
    prepare(spark)
    ids = docs.select("doc_id", text_of(docs).alias("text")).withColumn("ids", tree_bpe.encode_column(F.col("text")))
    back = tree_bpe.decode_column(F.col("ids"))
    return ids.select("doc_id", "ids", F.size("ids").cast("long").alias("n_tokens"),
                      (back == F.coalesce("text", F.lit("")).cast("binary")).alias("round_trip"))


STAGES = [
    ("quality rules", quality_rules),
    ("near-duplicates", near_dedup),
    ("benchmark decontamination", decontaminate),
    ("personal data", redact_pii),
    ("byte-level BPE", tokenize),
]

#: The quality model and the redaction are not SQL; the tests hold ``run`` against
#: a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
