"""Helpers shared by the training-data operators."""

from __future__ import annotations

import os
import re
import uuid
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.session import ensure_checkpoint_dir

#: Words of the matching operators, in text whose A-Z are lower-cased, as UTF-8.
MATCH_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")


#: Rows that a Python worker gets at once: documents are long, so few.
BATCH_ROWS = 1_000


def prepare(spark: SparkSession) -> None:
    """Settings for the Python workers: bounded Arrow batches, unless the session
    asks for smaller ones, and this package importable from where the driver has
    it (on clusters without shared folders it is shipped with ``--py-files``)."""
    rows = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(rows)) <= BATCH_ROWS:
        spark.conf.set(rows, str(BATCH_ROWS))
    env, root = spark.sparkContext.environment, str(Path(__file__).resolve().parents[2])
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([root, *paths])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_folder(spark: SparkSession, kind: str) -> str:
    """A new folder name under the session's shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/strata-{kind}/{uuid.uuid4().hex}"


def utf8(text: str | None) -> bytes:
    return b"" if text is None else text.encode("utf-8", "surrogatepass")


def match_words(text: str | None) -> list[bytes]:
    """``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the text with A-Z lower-cased
    (``bytes.lower`` changes A-Z only; bytes of other characters are >= 0x80)."""
    return MATCH_WORD.findall(utf8(text).lower())


def free_name(df: DataFrame, stem: str) -> str:
    """A column name that ``df`` does not have (names compare without case)."""
    taken = {c.lower() for c in df.columns}
    while stem.lower() in taken:
        stem += "_"
    return stem


def bounded_rows(df: DataFrame, most: int) -> DataFrame:
    """At most ``most`` distinct rows (doc_id, ...), those with the smallest hashes of id and row:
    however often a row or an id is repeated, no more go on.  Only hashes are sorted and compared;
    the rows come back by them."""
    one, two = free_name(df, "_one"), free_name(df, "_two")
    marked = df.withColumn(one, F.xxhash64("doc_id", F.lit(17))).withColumn(two, F.xxhash64(*df.columns))
    first = marked.select(one, two).distinct().orderBy(one, two).limit(most)
    return marked.join(F.broadcast(first), [one, two], "left_semi").select(*df.columns).dropDuplicates()


def text_of(df: DataFrame) -> Column:
    return F.col("text").cast("string")
