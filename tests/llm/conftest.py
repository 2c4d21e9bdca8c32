import pytest
from pyspark.sql import types as T

SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                       T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()), T.StructField("score", T.StringType()),
                       T.StructField("_verdict", T.StringType())])
LABELS = "doc_id long, quality int, toxic int"
BENCH = "item_id long, text string"

CLEAN = " ".join(f"word{i % 37} and other{i % 23} thing{i}" for i in range(40))
EDGES = ["", None, "   \n\t", "one", "Two words", "Ünï çödé «x» 漢字", CLEAN, CLEAN, "a " * 30_000, "x" * 60_000, "\x1c\x85  odd spaces"]


@pytest.fixture(scope="session")
def make(spark):
    """Documents from texts; extra columns whose names clash with outputs."""
    from strata.llm.common import prepare
    prepare(spark)

    def docs(texts, ids=None):
        ids = range(len(texts)) if ids is None else ids
        return spark.createDataFrame([(i, t, None, None, None, "mine", "mine too") for i, t in zip(ids, texts, strict=True)], SCHEMA)
    return docs
