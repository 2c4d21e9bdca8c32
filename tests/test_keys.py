"""Distributed numbering equals the single-partition window functions."""
import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from strata.operators.keys import assign_keys, global_ntile, global_rank


def _data(spark, n, seed):
    rnd = random.Random(seed)
    rows = [(i, rnd.choice([None, 1.0, 2.0, 2.0, 3.5, 7.0, float(rnd.randint(0, 30))])) for i in range(n)]
    return spark.createDataFrame(rows, "id long, v double")


def test_assign_keys_dense(spark):
    df = _data(spark, 500, 1)
    out = assign_keys(df, [F.col("id").desc()], "sk", start=10)
    got = sorted((r.id, r.sk) for r in out.collect())
    assert got == sorted((i, 10 + 500 - i) for i in range(500))


def test_global_rank_matches_window(spark):
    for n, seed in [(1, 2), (37, 3), (1000, 4)]:
        df = _data(spark, n, seed)
        mine = global_rank(df, [("v", "desc")], "r")
        ref = df.withColumn("r", F.rank().over(Window.orderBy(F.col("v").desc_nulls_last())))
        assert sorted((x.id, x.r) for x in mine.collect()) == sorted((x.id, x.r) for x in ref.collect())


def test_global_ntile_matches_window(spark):
    for n, tiles in [(3, 5), (23, 5), (100, 4), (7, 10), (11, 4), (1000, 10)]:
        df = _data(spark, n, n)
        order = [F.col("v").desc_nulls_last(), F.col("id").asc()]
        mine = global_ntile(df, tiles, order, "t")
        ref = df.withColumn("t", F.ntile(tiles).over(Window.orderBy(*order)))
        assert sorted((x.id, x.t) for x in mine.collect()) == sorted((x.id, x.t) for x in ref.collect())


def test_global_rank_unique_key_matches_window(spark):
    for n, seed in [(1, 5), (50, 6), (800, 7)]:
        df = _data(spark, n, seed)
        mine = global_rank(df, [("v", "desc")], "r", unique_key="id")
        ref = df.withColumn("r", F.rank().over(Window.orderBy(F.col("v").desc_nulls_last())))
        assert sorted((x.id, x.r) for x in mine.collect()) == sorted((x.id, x.r) for x in ref.collect())


def test_global_positions_equal_windows(spark):
    import random

    from pyspark.sql import Window

    from strata.operators.keys import global_positions
    r = random.Random(5)
    rows = [(f"k{i}", r.choice([None, 0.0, -0.0, 1.5, float(i)]), r.choice([None, 1, 2, i]), r.random()) for i in range(203)] + [(None, 1.5, 2, 0.5)]
    df = spark.createDataFrame(rows, "k string, a double, b long, other double").repartition(5)
    got = global_positions(df, "k", {"ra": ("a", "desc"), "rb": ("b", "asc")}, {"ta": (7, "a", "desc"), "tb": (4, "b", "asc")})
    key = F.col("k").asc_nulls_last()
    a, b = F.col("a").desc_nulls_last(), F.col("b").asc_nulls_last()
    want = df.select("*", F.rank().over(Window.orderBy(a)).cast("long").alias("ra"), F.rank().over(Window.orderBy(b)).cast("long").alias("rb"),
                     F.ntile(7).over(Window.orderBy(a, key)).cast("long").alias("ta"), F.ntile(4).over(Window.orderBy(b, key)).cast("long").alias("tb"))
    assert got.columns == want.columns
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))
    assert global_positions(df.where("false"), "k", {"ra": ("a", "desc")}).collect() == []
