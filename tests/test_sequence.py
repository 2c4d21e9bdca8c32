"""Two-level sequence operators equal plain per-key windows."""
import datetime as dt
import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from strata.operators import sequence as S


def _events(spark, n=600, seed=11):
    rnd = random.Random(seed)
    base = dt.datetime(2024, 1, 1)
    rows = []
    for i in range(n):
        k = 0 if rnd.random() < 0.5 else rnd.randint(1, 5)          # key 0 is hot
        ts = base + dt.timedelta(minutes=rnd.randint(0, 60 * 24 * 3))
        rows.append((i, k, ts, rnd.randint(0, 1)))
    return spark.createDataFrame(rows, "id long, k long, ts timestamp_ntz, flag int")


def test_prev_value_and_running_count(spark):
    df = _events(spark)
    w = Window.partitionBy("k").orderBy("ts", "id")
    ref = (df.withColumn("p", F.lag("flag").over(w))
             .withColumn("c", F.sum("flag").over(w.rowsBetween(Window.unboundedPreceding, 0))))
    mine = S.prev_value(S.with_bucket(df, "ts", "hour"), "k", "ts", ["id"], "flag", "p")
    mine = S.running_count(mine, "k", "ts", ["id"], "flag", "c")
    assert sorted((r.id, r.p, r.c) for r in mine.collect()) == sorted((r.id, r.p, r.c) for r in ref.collect())


def test_gap_sessions(spark):
    df = _events(spark, seed=12)
    w = Window.partitionBy("k").orderBy("ts", "id")
    prev = F.lag("ts").over(w)
    ref = df.withColumn("_n", F.when(prev.isNull() | (F.col("ts") > prev + F.expr("INTERVAL 30 MINUTES")), 1)
                        .otherwise(0))
    ref = ref.withColumn("s", F.sum("_n").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    mine = S.gap_sessions(df, "k", "ts", ["id"], F.expr("INTERVAL 30 MINUTES"), "s")
    assert sorted((r.id, r.s) for r in mine.collect()) == sorted((r.id, r.s) for r in ref.collect())
