"""Golden mini-tables for the silver load patterns (SV1-SV8)."""
import datetime as dt

from pyspark.sql import functions as F

from strata.operators.load import (
    insert_if_absent, latest_per_key, replace_partition, require_keys, scd1_upsert, scd2_upsert, split_required,
)

T1 = dt.datetime(2024, 1, 1, 1)
T2 = dt.datetime(2024, 1, 1, 2)
T3 = dt.datetime(2024, 1, 1, 3)


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_latest_per_key_picks_latest_and_breaks_ties(spark):
    df = spark.createDataFrame(
        [("a", T1, 1, "old"), ("a", T2, 1, "new"), ("b", T1, 1, "x"), ("b", T1, 2, "y"), ("c", None, 1, "n"),
         ("c", T1, 0, "t")], "k string, ts timestamp_ntz, tie int, v string")
    out = latest_per_key(df, ["k"], ["ts", "tie"])
    assert rows(out, "k", "v") == [("a", "new"), ("b", "y"), ("c", "t")]


def test_require_keys_and_split(spark):
    df = spark.createDataFrame([("a", 1), (None, 2)], "k string, v int")
    assert require_keys(df, ["k"]).count() == 1
    good, bad = split_required(df, ["k"])
    assert good.count() == 1 and bad.count() == 1


def _src(spark, data):
    return spark.createDataFrame(data, "id string, status string, total int, note string")


def test_scd1_insert_then_update(spark):
    v1 = scd1_upsert(None, _src(spark, [("1", "NEW", 10, "a"), ("2", "NEW", 20, "b")]), ["id"], "sk",
                     ["status", "total"], T1)
    assert rows(v1, "sk", "id", "status") == [(1, "1", "NEW"), (2, "2", "NEW")]
    v2 = scd1_upsert(v1, _src(spark, [("2", "SHIPPED", 25, "changed"), ("3", "NEW", 30, "c")]), ["id"], "sk",
                     ["status", "total"], T2)
    got = rows(v2, "sk", "id", "status", "total", "note")
    # matched: only update columns change; new key gets the next surrogate key
    assert got == [(1, "1", "NEW", 10, "a"), (2, "2", "SHIPPED", 25, "b"), (3, "3", "NEW", 30, "c")]
    # idempotent re-run
    v3 = scd1_upsert(v2, _src(spark, [("2", "SHIPPED", 25, "changed")]), ["id"], "sk", ["status", "total"], T3)
    assert rows(v3, "sk", "id", "status", "total") == rows(v2, "sk", "id", "status", "total")


def _cust(spark, data):
    return spark.createDataFrame(data, "customer_id string, email string, tier string")


def test_scd2_atomic_closes_and_inserts(spark):
    v1 = scd2_upsert(None, _cust(spark, [("1", "a@x", "GOLD"), ("2", None, "SILVER")]), ["customer_id"], "sk",
                     ["email", "tier"], T1)
    v2 = scd2_upsert(v1, _cust(spark, [("1", "b@x", "GOLD"), ("2", "c@x", "SILVER"), ("3", "d@x", None)]),
                     ["customer_id"], "sk", ["email", "tier"], T2)
    got = rows(v2, "sk", "customer_id", "email", "is_current", "effective_from", "effective_to")
    eot = dt.datetime(9999, 12, 31)
    assert got == [
        (1, "1", "a@x", False, T1, T2),
        (2, "2", None, False, T1, T2),       # null -> value is a change (null-safe compare)
        (3, "1", "b@x", True, T2, eot),
        (4, "2", "c@x", True, T2, eot),
        (5, "3", "d@x", True, T2, eot),
    ]
    # unchanged re-run keeps the table
    v3 = scd2_upsert(v2, _cust(spark, [("1", "b@x", "GOLD")]), ["customer_id"], "sk", ["email", "tier"], T3)
    assert v3.count() == 5 and v3.filter("is_current").count() == 3


def test_scd2_two_run_mode(spark):
    v1 = scd2_upsert(None, _cust(spark, [("1", "a@x", "GOLD")]), ["customer_id"], "sk", ["email"], T1)
    src = _cust(spark, [("1", "b@x", "GOLD")])
    v2 = scd2_upsert(v1, src, ["customer_id"], "sk", ["email"], T2, atomic=False)
    assert v2.filter("is_current").count() == 0           # closed, new version not yet inserted
    v3 = scd2_upsert(v2, src, ["customer_id"], "sk", ["email"], T3, atomic=False)
    assert rows(v3.filter("is_current"), "customer_id", "email") == [("1", "b@x")]


def test_insert_if_absent_and_replace_partition(spark):
    t = spark.createDataFrame([("1", "a")], "k string, v string")
    s = spark.createDataFrame([("1", "changed"), ("2", "b")], "k string, v string")
    assert rows(insert_if_absent(t, s, ["k"]), "k", "v") == [("1", "a"), ("2", "b")]
    d1, d2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
    tgt = spark.createDataFrame([(d1, "old"), (d2, "old")], "d date, v string")
    fresh = spark.createDataFrame([(d2, "new")], "d date, v string")
    assert rows(replace_partition(tgt, fresh, "d"), "d", "v") == [(d1, "old"), (d2, "new")]


def test_latest_per_key_packs_mixed_and_repeated_orders(spark):
    df = spark.createDataFrame([("a", 1, 5), ("a", 2, 3), ("a", 2, 4), ("b", None, 1)], "k string, t int, v int")
    out = latest_per_key(df, ["k"], ["t", F.col("v") * -1, "t", "k"])
    assert sorted(map(tuple, out.collect())) == [("a", 2, 3), ("b", None, 1)]
