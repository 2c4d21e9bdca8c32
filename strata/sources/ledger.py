"""IN8 / IN10: a load history, one row for each file that was read.

A file is known by its path, size and time of change.  A load lists the files of its landing folder,
reads those that the history lacks, and adds a row for each: good and bad records, and a status
(``LOADED``, ``PARTIALLY_LOADED``, ``LOAD_FAILED`` where all records are bad, ``EMPTY``).  So a file is
read once even if none of its records was good, and read again only if it changed.  Files of no bytes
hold nothing to read and are not listed.

Runs of a history are folders named by the run, written anew by a replay.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.compat import lit_ts
from strata.session import materialize
from strata.sources.raw import ENVELOPE, READERS, SOURCES, lift_keys, split_bad, with_batch

HISTORY = "path string, size long, changed timestamp, good long, bad long, status string, loaded_at timestamp_ntz, run string"


def history(spark: SparkSession, folder: str) -> DataFrame:
    """All files read so far."""
    try:
        return spark.read.schema(HISTORY).parquet(folder)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], HISTORY)
        raise


def landed_files(spark: SparkSession, path: str) -> DataFrame:
    """(path, place, size, changed) of the files in a landing folder; their contents are not read.
    ``path`` is the name that rows carry, ``place`` the one to read from."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.select(F.col("_metadata.file_path").alias("path"), F.col("path").alias("place"), F.col("length").alias("size"), F.col("modificationTime").alias("changed"))


def land_new(spark: SparkSession, source: str, path: str, folder: str, run: str, run_ts, batch_id: str | None = None) -> tuple[DataFrame | None, DataFrame | None]:
    """Read the files that the history in ``folder`` lacks -> (raw rows, quarantine), both written once,
    and add them to the history as ``run``; (None, None) if there is none.  A replayed run does not
    count its own earlier rows."""
    src = SOURCES[source]
    known = history(spark, folder).where(F.col("run") != run)
    fresh = materialize(landed_files(spark, path).join(known.select("path", "size", "changed"), ["path", "size", "changed"], "left_anti"))
    paths = [r["place"] for r in fresh.select("place").collect()]  # names of the files of one load
    if not paths:
        return None, None
    rows = READERS[src.fmt](spark, paths)
    if src.fmt == "parquet":  # the other readers have written their rows
        rows = materialize(rows)
    good, bad = split_bad(rows)
    counts = rows.groupBy(F.col("file_name").alias("path")).agg(
        F.count(F.when(_is_good(), 1)).alias("good"), F.count(F.when(~_is_good(), 1)).alias("bad"))
    zero = F.lit(0).cast("long")
    found = fresh.join(counts, "path", "left").select("path", "size", "changed", F.coalesce("good", zero).alias("good"), F.coalesce("bad", zero).alias("bad"))
    status = (F.when((F.col("good") == 0) & (F.col("bad") == 0), "EMPTY").when(F.col("bad") == 0, "LOADED")
              .when(F.col("good") == 0, "LOAD_FAILED").otherwise("PARTIALLY_LOADED"))
    (found.withColumn("status", status).withColumn("loaded_at", lit_ts(run_ts)).withColumn("run", F.lit(run))
     .write.mode("overwrite").parquet(f"{folder.rstrip('/')}/load={run}"))
    good = with_batch(lift_keys(good, src.keys), None if src.streaming else batch_id, run_ts)
    return good.select(*src.keys.keys(), *ENVELOPE), bad


def _is_good():
    return F.col("payload").isNotNull() & F.col("_corrupt_record").isNull()
