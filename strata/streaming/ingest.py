"""IN9 / IN10: continuous file ingest into the raw layer.

``stream_raw`` reads JSON files from a landing folder as one variant per
record (arrays are taken apart, rows numbered), lifts the keys and writes the raw envelope to a parquet table by epoch.  The
streaming file source's checkpoint records which files were committed, so a
restart (or a lost executor) never loads a file twice.  ``foreachBatch``
lets the same micro-batch also feed a silver upsert.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.sources.raw import ENVELOPE, SOURCES, json_records, lift_keys, split_bad, with_lineage


def raw_stream(spark: SparkSession, source: str, path: str, multi_line: bool = False) -> DataFrame:
    """The records of a landing folder as the batch reader gives them, arrays taken apart; ``numbered``
    turns the file blocks of a micro-batch into row numbers."""
    src = SOURCES[source]
    df = lift_keys(json_records(spark.readStream, path, multi_line), src.keys)
    return df.select(*src.keys.keys(), "payload", "_corrupt_record", "file_name", "_block",
                     F.current_timestamp().cast("timestamp_ntz").alias("load_timestamp"),
                     F.lit(None).cast("string").alias("batch_id"))


def numbered(batch: DataFrame) -> DataFrame:
    """A micro-batch, read once, with ``file_row_number``: a file is never split over micro-batches."""
    return with_lineage(batch)


def stream_raw(spark: SparkSession, source: str, path: str, table_dir: str, checkpoint_dir: str,
               on_batch=None, available_now: bool = True, multi_line: bool = False):
    """Start the ingest; ``on_batch(good_rows, epoch_id)`` runs after each write.

    Every epoch overwrites its own folder ``epoch=<id>``, so a replay after a
    failure leaves one copy.  Lines that do not parse go, the same way, to the
    quarantine table beside the raw table (``<table_dir>_quarantine``)."""
    stream = raw_stream(spark, source, path, multi_line)

    def write(batch: DataFrame, epoch_id: int) -> None:
        good, bad = split_bad(numbered(batch))
        part = f"epoch={epoch_id}"
        good.select(*SOURCES[source].keys.keys(), *ENVELOPE).write.mode("overwrite").parquet(f"{table_dir}/{part}")
        bad.select("_corrupt_record", "file_name", "file_row_number", "load_timestamp").write.mode("overwrite") \
            .parquet(f"{table_dir.rstrip('/')}_quarantine/{part}")
        if on_batch is not None:
            on_batch(good, epoch_id)

    w = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint_dir)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="60 seconds")
    return w.start()


def upsert_stream(spark: SparkSession, source: str, path: str, base: str, table: str, job,
                  checkpoint_dir: str, available_now: bool = True):
    """Stream a landing folder straight into a silver table (the payments
    pipe -> type-1 merge of the reference): every micro-batch runs the silver
    ``job(raw_batch, current_table, run_ts)`` against the current version and
    publishes the result as version ``epoch=<id>``; lines that do not parse go to
    ``<base>/<table>_quarantine``.  An epoch that is replayed
    after its version was published is skipped; one that failed before that reads
    the version before it and writes its own folder anew."""
    from strata.sources import sinks

    stream = raw_stream(spark, source, path)

    def run(batch: DataFrame, epoch_id: int) -> None:
        version = f"epoch={epoch_id:012d}"
        if sinks.current_version(spark, base, table) == version:
            return
        batch = _quarantined(batch, f"{base.rstrip('/')}/{table}_quarantine", epoch_id)
        if batch.isEmpty():
            return
        current = sinks.read_current(spark, base, table)
        run_ts = batch.agg(F.max("load_timestamp")).first()[0]
        nxt = job(batch, current, run_ts)
        sinks.publish(nxt, base, table, run_ts, version=version, audit=False)

    w = stream.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint_dir)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="60 seconds")
    return w.start()


def _quarantined(batch: DataFrame, folder: str, epoch_id: int) -> DataFrame:
    """The good rows; lines that do not parse go to the epoch's folder of the quarantine."""
    good, bad = split_bad(numbered(batch))
    bad.select("_corrupt_record", "file_name", "file_row_number", "load_timestamp").write.mode("overwrite").parquet(f"{folder}/epoch={epoch_id}")
    return good


def merge_stream(spark: SparkSession, source: str, path: str, base: str, table: str, merge, checkpoint_dir: str, available_now: bool = True):
    """As ``upsert_stream`` into a table in key buckets: ``merge(batch, base, version, run_ts)`` rewrites
    only the buckets of the micro-batch, and a replayed epoch is skipped by its version."""
    stream = raw_stream(spark, source, path)

    def run(batch: DataFrame, epoch_id: int) -> None:
        good = _quarantined(batch, f"{base.rstrip('/')}/{table}_quarantine", epoch_id)
        run_ts = good.agg(F.max("load_timestamp")).first()[0]
        if run_ts is not None:
            merge(good, base, f"epoch{epoch_id:012d}", run_ts)

    w = stream.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint_dir)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="60 seconds")
    return w.start()


def dedup_within_watermark(stream: DataFrame, keys: list[str], event_time: str, delay: str) -> DataFrame:
    """Drop late repeats of a key with bounded state: a repeat arriving within
    ``delay`` of the first copy is dropped, state older than the watermark is
    evicted (the bounded-state form of the reference's NOT EXISTS check)."""
    return stream.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(keys)
