"""Merges that rewrite touched buckets only, the load history, and streams that keep bad rows."""
import json
import os
import tempfile

from pyspark.sql import functions as F

from strata.operators.load import scd1_upsert
from strata.plans import silver
from strata.sources import buckets as B
from strata.sources import ledger, raw
from strata.streaming import ingest
from strata.streaming import telemetry as T

RUN = "2024-01-01 00:00:00"


def files(base):
    return {os.path.join(d, f)[len(base):] for d, _, names in os.walk(base) for f in names if f.endswith(".parquet") and "_manifest" not in d}


def merge(spark, base, rows, version, buckets=8):
    job = lambda s, t, top: scd1_upsert(t, s, ["k"], "sk", ["v"], RUN, top=top)
    return B.merge(spark.createDataFrame(rows, "k string, v int"), base, "t", ["k"], "sk", job, version, buckets)


def test_merge_leaves_untouched_files(spark):
    base = tempfile.mkdtemp(prefix="strata-buckets-")
    assert len(merge(spark, base, [(f"k{i}", i) for i in range(100)], "v1")) == 8
    first, before = files(base), B.manifest(spark, base, "t")
    touched = merge(spark, base, [("k3", -3), ("new", 7)], "v2")
    assert 1 <= len(touched) <= 2 and first < files(base)
    assert all(f"{B.BUCKET}={b}/" not in f for f in files(base) - first for b in set(range(8)) - set(touched))
    got = {r["k"]: (r["sk"], r["v"]) for r in B.read(spark, base, "t").collect()}
    assert len(got) == 101 and got["k3"][1] == -3 and got["new"] == (101, 7) and got["k4"][1] == 4
    assert {sk for sk, _ in got.values()} == set(range(1, 102))
    # unread files: only the files of touched buckets are in the new version's plan
    after = B.manifest(spark, base, "t")
    assert {b for b, p in after.places.items() if before.places[b] != p} == set(touched)
    diff = B.changed(spark, base, "t", ["k"], before, after, ["v"]).collect()
    assert sorted((r["k"], r["old"] and r["old"]["v"], r["new"]["v"]) for r in diff) == [("k3", 3, -3), ("new", None, 7)]
    # a replay changes nothing; a merge that failed before its manifest is not seen
    assert merge(spark, base, [("k3", 99)], "v2") == []
    try:
        B.merge(spark.createDataFrame([("k5", 1)], "k string, v int"), base, "t", ["k"], "sk", lambda s, t, top: s.select(F.raise_error(F.lit("lost")).alias("k")), "v3")
    except Exception:
        pass
    assert {r["k"]: r["v"] for r in B.read(spark, base, "t").collect()}["k3"] == -3
    assert merge(spark, base, [], "v4") == [] and B.read(spark, base, "t").count() == 101


def test_first_merge_empty(spark):
    base = tempfile.mkdtemp(prefix="strata-buckets-")
    assert B.read(spark, base, "t") is None
    assert merge(spark, base, [], "v1") == [] and B.read(spark, base, "t") is None
    merge(spark, base, [("a", 1)], "v2")
    assert [(r["sk"], r["k"]) for r in B.read(spark, base, "t").collect()] == [(1, "a")]


def test_payments_stream_into_buckets_keeps_bad_lines(spark):
    base = tempfile.mkdtemp(prefix="strata-merge-")
    land, out, ckpt = (os.path.join(base, x) for x in ("land", "out", "ckpt"))
    os.makedirs(land)
    run = lambda: ingest.merge_stream(spark, "payments", land, out, "payments", lambda b, base, v, ts: silver.merge_payments(b, base, v, ts, 4), ckpt).awaitTermination()
    with open(os.path.join(land, "a.json"), "w") as f:
        f.write('{"payment_id": "P1", "status": "captured"}\nnot json\n{"payment_id": "P2", "status": "captured"}\n{"status": "lost"}\n')
    run()
    run()
    with open(os.path.join(land, "b.json"), "w") as f:
        f.write('{"payment_id": "P2", "status": "refunded"}\n')
    run()
    got = sorted((r["payment_sk"], r["payment_id"], r["payment_status"]) for r in B.read(spark, out, "payments").collect())
    assert got == [(1, "P1", "CAPTURED"), (2, "P2", "REFUNDED")]
    assert [r["_corrupt_record"] for r in spark.read.parquet(f"{out}/payments_quarantine").collect()] == ["not json"]


def test_load_history_reads_every_file_once(spark):
    base = tempfile.mkdtemp(prefix="strata-ledger-")
    land, hist = os.path.join(base, "land dir"), os.path.join(base, "history")
    os.makedirs(land)

    def put(name, text):
        with open(os.path.join(land, name), "w") as f:
            f.write(text)

    put("good.json", '{"order_id": "1"}\n{"order_id": "2"}\n')
    put("mixed.json", '{"order_id": "3"}\nbroken\n')
    put("bad.json", "broken\n")
    put("empty.json", "")  # nothing to read: never listed
    put("blank.json", "\n\n")
    good, bad = ledger.land_new(spark, "orders", land, hist, "r1", RUN, "b1")
    assert sorted(r["src_order_id"] for r in good.collect()) == ["1", "2", "3"] and bad.count() == 2
    seen = {r["path"].rsplit("/", 1)[1]: (r["good"], r["bad"], r["status"]) for r in ledger.history(spark, hist).collect()}
    assert seen == {"good.json": (2, 0, "LOADED"), "mixed.json": (1, 1, "PARTIALLY_LOADED"), "bad.json": (0, 1, "LOAD_FAILED"), "blank.json": (0, 0, "EMPTY")}
    assert ledger.land_new(spark, "orders", land, hist, "r2", RUN) == (None, None)
    put("later.json", '{"order_id": "4"}\n')
    good, bad = ledger.land_new(spark, "orders", land, hist, "r3", RUN)
    assert [r["src_order_id"] for r in good.collect()] == ["4"] and bad.count() == 0
    # a replayed run reads its own files again and leaves one history row for each
    assert ledger.land_new(spark, "orders", land, hist, "r3", RUN)[0].count() == 1
    assert ledger.history(spark, hist).count() == 5


def test_untimed_snapshots_are_inserted_once(spark):
    rows = [json.dumps({"product_id": "p", "location_id": "l", "qty_on_hand": 3}), json.dumps({"product_id": "p", "location_id": "l", "snapshot_ts": "2024-01-01 06:00:00"})]
    src = spark.createDataFrame([(r,) for r in rows], "v string").select(F.parse_json("v").alias("payload"))
    src = raw.with_batch(src, "b", RUN)
    once = silver.s07_inventory(src, None, RUN)
    assert once.count() == 2 and silver.s07_inventory(src, once, RUN).count() == 2


def test_bad_readings_are_kept(spark):
    base = tempfile.mkdtemp(prefix="strata-readings-")
    src, sink, ckpt = (os.path.join(base, x) for x in ("in", "out", "ckpt"))
    os.makedirs(src)
    with open(os.path.join(src, "a.json"), "w") as f:
        for node, load in (("node-substation-north", 95.0), ("node-substation-north", None), (None, 99.0)):
            f.write(json.dumps({"node_id": node, "timestamp": "2024-01-01 00:00:00", "voltage_kv": 132.0, "load_pct": load, "frequency_hz": 50.0}) + "\n")
    for _ in range(2):
        T.alert_stream(spark, src, sink, ckpt).awaitTermination()
    assert spark.read.parquet(sink).count() == 1 and spark.read.parquet(f"{sink}_quarantine").count() == 2
