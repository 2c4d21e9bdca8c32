"""Table sinks: versioned publish (CTAS / TRUNCATE+INSERT / MERGE results)
and dynamic partition overwrite.

A table cannot be overwritten by the plan that reads it, so every published
version goes to its own folder and a numbered one-line pointer names the current one
(DM1).  Readers of an older version are never disturbed; a failed publish
leaves the pointer on the previous version.  All writes go through Spark, so
the same code works on any shared file system or object store.
"""

from __future__ import annotations

import datetime as dt

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.compat import lit_ts


def version_name(run_ts) -> str:
    if isinstance(run_ts, str):
        run_ts = dt.datetime.fromisoformat(run_ts)
    return "v=" + run_ts.strftime("%Y%m%dT%H%M%S%f")


def publish(df: DataFrame, base: str, table: str, run_ts, partition_by: list[str] | None = None,
            version: str | None = None, audit: bool = True) -> str:
    """Write a new version of ``table`` and switch the pointer to it.
    DM10: ``dw_refreshed_at`` records the run time of the version.

    Only a ``version`` given by name (a stream's epoch) is skipped when it is
    current.  Without one every call publishes; if its run time already names a
    version, which its plan or a reader may read, the folder gets a number."""
    spark = df.sparkSession
    number, current = _pointer(spark, base, table)
    if version and current == version:  # a replay: the version stands, and its own plan may read it
        return f"{base.rstrip('/')}/{table}/{version}"
    v = version or version_name(run_ts)
    if not version and _published(spark, base, table, v):
        v = f"{v}-{number + 1}"
    path = f"{base.rstrip('/')}/{table}/{v}"
    out = df.withColumn("dw_refreshed_at", lit_ts(run_ts)) if audit else df
    w = out.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    # pointers are only added, never overwritten: a reader finds the old one or the new one
    spark.createDataFrame([(v,)], "value string").coalesce(1).write.mode("overwrite") \
        .text(f"{base.rstrip('/')}/{table}/_current/n={number + 1}")
    return path


def _pointer(spark: SparkSession, base: str, table: str) -> tuple[int, str | None]:
    """(number, version) of the newest pointer; (0, None) if the table has none."""
    rows = _pointers(spark, base, table)
    newest = rows.orderBy(F.desc("n")).first() if rows is not None else None
    return (newest["n"], newest["value"]) if newest else (0, None)


def _pointers(spark: SparkSession, base: str, table: str) -> DataFrame | None:
    """(value, n) of all pointers, None if the table has none.  Any error but a
    missing path is raised."""
    try:
        return spark.read.schema("value string, n long").text(f"{base.rstrip('/')}/{table}/_current")
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def _published(spark: SparkSession, base: str, table: str, version: str) -> bool:
    rows = _pointers(spark, base, table)
    return rows is not None and not rows.where(F.col("value") == version).isEmpty()


def current_version(spark: SparkSession, base: str, table: str) -> str | None:
    return _pointer(spark, base, table)[1]


def read_current(spark: SparkSession, base: str, table: str) -> DataFrame | None:
    """The current version of ``table`` (None before the first publish)."""
    v = current_version(spark, base, table)
    return None if v is None else spark.read.parquet(f"{base.rstrip('/')}/{table}/{v}")


def write_partitions(df: DataFrame, path: str, part_col: str) -> None:
    """SV6 / DM4: replace exactly the ``part_col`` partitions present in
    ``df`` (dynamic partition overwrite); other partitions stay."""
    (df.write.option("partitionOverwriteMode", "dynamic").mode("overwrite")
       .partitionBy(part_col).parquet(path))
