"""Join helpers.

Broadcast policy: a side is hinted for broadcast only when its size has a
*structural* bound that does not grow with the data (one row per calendar
day, per nation/store, per partition, a one-row aggregate).  Every other join
is left to the planner: with AQE on, Spark measures the finished shuffle
stage and switches to a broadcast only when the measured size is below
``spark.sql.adaptive.autoBroadcastJoinThreshold``, otherwise it keeps the
sort-merge join (and splits skewed partitions).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Structural row bounds of the relations we hint (fixed values of the model).
BOUND_DATE_DIM = 60_000        # dim_date: one row per calendar day (< 165 years)
BOUND_STORES = 10_000          # one store per location
BOUND_ONE_ROW = 1


def bounded_broadcast(df: DataFrame, bound_rows: int) -> DataFrame:
    """Hint ``df`` for broadcast; ``bound_rows`` documents the structural bound
    that makes the hint safe.  Bounds above one million rows are refused so a
    growing relation is never broadcast by mistake."""
    if bound_rows > 1_000_000:
        raise ValueError("relation is not bounded small enough to broadcast")
    return F.broadcast(df)
