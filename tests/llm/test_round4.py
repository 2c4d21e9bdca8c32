"""The quality model is fitted on all trusted documents."""
import numpy as np
from pyspark.sql import functions as F

from strata.llm import llr_quality


def _labels(spark, n):
    return spark.range(n).select(F.col("id").alias("doc_id"), F.lit(1).alias("quality"), F.lit(0).alias("toxic"))


def test_every_trusted_id_counts(spark):
    more = _labels(spark, 20_500)
    assert llr_quality.trusted_ids(more.unionByName(more)).count() == 20_500


def test_blocks_of_ids_mark_each_trusted_document_once(spark):
    docs = spark.range(400).select(F.col("id").alias("doc_id"), F.concat(F.lit("good words "), (F.col("id") % 7).cast("string")).alias("text"))
    docs = docs.unionByName(spark.createDataFrame([(5, "again"), (None, "no id"), (900, None)], "doc_id long, text string"))
    labels = _labels(spark, 300)
    marked = llr_quality.with_trusted(docs, labels, ids=40)
    assert marked.count() == 403 and marked.where("trusted").count() == 301
    assert np.array_equal(llr_quality.fit(docs, labels, bits=10, ids=40), llr_quality.fit(docs, labels, bits=10))
    assert llr_quality.fit(docs, labels, bits=10).any()
