"""Ordered per-key sequence logic (LAG / running counts) without putting a
key's whole history into one task.

A window ``PARTITION BY key ORDER BY ts`` sorts every row of a key in one
task; a key holding a third of all rows would stall the job.  These helpers
split each key's history into time buckets (hour / day ...):

* the per-row work (LAG inside the bucket, running count inside the bucket)
  runs in windows partitioned by (key, bucket), bounded by the event rate;
* the only cross-bucket step runs over a one-row-per-(key, bucket) summary,
  whose size is bounded by the calendar, not by the data;
* the two are combined with equi-joins on (key, bucket).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUCKET = "_sq_bucket"


def with_bucket(df: DataFrame, ts: str, unit: str = "hour") -> DataFrame:
    return df.withColumn(BUCKET, F.date_trunc(unit, F.col(ts)))


def prev_value(df: DataFrame, key: str, ts: str, order: list[str], value: str, out: str) -> DataFrame:
    """``out`` = ``value`` of the previous row of the same key in (ts, order)
    order -- LAG(value) OVER (PARTITION BY key ORDER BY ts, order...).
    ``df`` must carry the bucket column (``with_bucket``)."""
    wb = Window.partitionBy(key, BUCKET).orderBy(ts, *order)
    local = df.withColumn("_sq_prev", F.lag(value).over(wb))
    last = (df.groupBy(key, BUCKET)
            .agg(F.max(F.struct(F.col(ts), *[F.col(o) for o in order], F.col(value).alias("_v"))).alias("_sq_l"))
            .select(key, BUCKET, F.col("_sq_l._v").alias("_sq_last")))
    prev_bucket = last.select(key, BUCKET, F.lag("_sq_last").over(Window.partitionBy(key).orderBy(BUCKET))
                              .alias("_sq_prev_bucket"))
    j = local.join(prev_bucket, [key, BUCKET])
    first_in_bucket = F.row_number().over(wb) == 1
    return (j.withColumn(out, F.when(first_in_bucket, F.col("_sq_prev_bucket")).otherwise(F.col("_sq_prev")))
             .drop("_sq_prev", "_sq_prev_bucket"))


def running_count(df: DataFrame, key: str, ts: str, order: list[str], flag: str, out: str) -> DataFrame:
    """``out`` = number of rows with ``flag`` = 1 up to and including this row
    of the same key, in (ts, order) order."""
    wb = Window.partitionBy(key, BUCKET).orderBy(ts, *order).rowsBetween(Window.unboundedPreceding, 0)
    local = df.withColumn("_sq_local", F.sum(flag).over(wb))
    per_bucket = df.groupBy(key, BUCKET).agg(F.sum(flag).alias("_sq_n"))
    before = F.coalesce(F.sum("_sq_n").over(Window.partitionBy(key).orderBy(BUCKET)
                                            .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    per_bucket = per_bucket.select(key, BUCKET, before.alias("_sq_before"))
    return (local.join(per_bucket, [key, BUCKET])
                 .withColumn(out, (F.col("_sq_before") + F.col("_sq_local")).cast("bigint"))
                 .drop("_sq_local", "_sq_before"))


def gap_sessions(df: DataFrame, key: str, ts: str, order: list[str], gap: Column, out: str,
                 unit: str = "day") -> DataFrame:
    """Sessionize: per key, a row starts a new session when there is no
    previous row or it is more than ``gap`` (an interval) after it; ``out``
    is the 1-based session number of the row within its key."""
    b = with_bucket(df, ts, unit)
    p = prev_value(b, key, ts, order, ts, "_sq_prev_ts")
    p = p.withColumn("_sq_new", F.when(F.col("_sq_prev_ts").isNull() | (F.col(ts) > F.col("_sq_prev_ts") + gap), 1)
                     .otherwise(0))
    return running_count(p, key, ts, order, "_sq_new", out).drop("_sq_prev_ts", "_sq_new", BUCKET)
