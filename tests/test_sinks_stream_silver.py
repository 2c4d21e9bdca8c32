"""Versioned publish, dynamic partition overwrite, stream -> silver upsert."""
import datetime as dt
import os
import tempfile

from pyspark.sql import functions as F

from strata.plans import silver
from strata.sources import sinks
from strata.streaming import ingest


def test_publish_switches_version_and_keeps_old(spark):
    base = tempfile.mkdtemp(prefix="strata-pub-")
    t1, t2 = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)
    p1 = sinks.publish(spark.range(3), base, "t", t1)
    assert sinks.read_current(spark, base, "t").count() == 3
    sinks.publish(spark.range(5), base, "t", t2)
    cur = sinks.read_current(spark, base, "t")
    assert cur.count() == 5 and cur.select(F.max("dw_refreshed_at")).first()[0] == t2
    assert spark.read.parquet(p1).count() == 3          # old version untouched


def test_write_partitions_replaces_only_present_days(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="strata-part-"), "seg")
    d1, d2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
    sinks.write_partitions(spark.createDataFrame([(d1, "a"), (d2, "b")], "segment_date date, v string"), path,
                           "segment_date")
    sinks.write_partitions(spark.createDataFrame([(d2, "c")], "segment_date date, v string"), path, "segment_date")
    got = sorted((r.segment_date, r.v) for r in spark.read.parquet(path).collect())
    assert got == [(d1, "a"), (d2, "c")]


def test_payments_stream_upserts_into_silver(spark):
    root = tempfile.mkdtemp(prefix="strata-pay-")
    land, base, ckpt = (os.path.join(root, x) for x in ("land", "silver", "ckpt"))
    os.makedirs(land)
    with open(os.path.join(land, "a.json"), "w") as fh:
        fh.write('{"payment_id": "P1", "order_id": "1", "status": "authorized", "amount": 10.5}\n')
        fh.write('{"payment_id": "P2", "order_id": "2", "status": "captured", "amount": 3}\n')
    ingest.upsert_stream(spark, "payments", land, base, "payments", silver.s08_payments, ckpt).awaitTermination()
    with open(os.path.join(land, "b.json"), "w") as fh:
        fh.write('{"payment_id": "P1", "order_id": "1", "status": "captured", "amount": 10.5}\n')
    ingest.upsert_stream(spark, "payments", land, base, "payments", silver.s08_payments, ckpt).awaitTermination()
    cur = sinks.read_current(spark, base, "payments")
    got = sorted((r.payment_id, r.payment_status, r.payment_sk) for r in cur.collect())
    assert got == [("P1", "CAPTURED", 1), ("P2", "CAPTURED", 2)]
    # restart without new files publishes nothing new
    v = sinks.current_version(spark, base, "payments")
    ingest.upsert_stream(spark, "payments", land, base, "payments", silver.s08_payments, ckpt).awaitTermination()
    assert sinks.current_version(spark, base, "payments") == v


def test_dedup_within_watermark(spark):
    root = tempfile.mkdtemp(prefix="strata-dedup-")
    src = os.path.join(root, "in")
    os.makedirs(src)
    with open(os.path.join(src, "a.json"), "w") as fh:
        for sid, ts in [("s1", "2024-01-01 00:00:00"), ("s1", "2024-01-01 00:05:00"), ("s2", "2024-01-01 00:06:00")]:
            fh.write(f'{{"session_id": "{sid}", "ts": "{ts}"}}\n')
    stream = spark.readStream.schema("session_id string, ts timestamp").json(src)
    out = ingest.dedup_within_watermark(stream, ["session_id"], "ts", "1 hour")
    q = out.writeStream.format("memory").queryName("dedup_test").trigger(availableNow=True).start()
    q.awaitTermination()
    assert sorted(r.session_id for r in spark.sql("SELECT * FROM dedup_test").collect()) == ["s1", "s2"]


def test_build_publishes_tables(spark):
    from strata.build import publish_tables
    from strata.plans.warehouse import Warehouse
    sf = "/root/testdata/sf0.001"
    if not os.path.exists(sf):
        return
    out = tempfile.mkdtemp(prefix="strata-build-")
    wh = Warehouse(spark, sf)
    publish_tables(wh, out, ["dim_stores", "daily_sales_summary"])
    for name in ["dim_stores", "daily_sales_summary"]:
        t = sinks.read_current(spark, out, name)
        assert t.count() > 0 and "dw_refreshed_at" in t.columns


def test_publishing_a_version_onto_itself_keeps_it(spark, tmpdir_path):
    base = tmpdir_path + "/replay"
    import datetime as dt
    run = dt.datetime(2024, 1, 1)
    sinks.publish(spark.range(3), base, "t", run, version="epoch=1", audit=False)
    sinks.publish(sinks.read_current(spark, base, "t"), base, "t", run, version="epoch=1", audit=False)
    assert sinks.read_current(spark, base, "t").count() == 3
    sinks.publish(spark.range(4), base, "t", run, version="epoch=2", audit=False)
    assert sinks.read_current(spark, base, "t").count() == 4 and sinks.current_version(spark, base, "missing") is None


def test_publishing_again_publishes_changed_input(spark, tmpdir_path):
    base = tmpdir_path + "/again"
    run = dt.datetime(2024, 1, 1)
    first = sinks.publish(spark.range(3), base, "t", run)
    second = sinks.publish(spark.range(5), base, "t", run)
    assert sinks.read_current(spark, base, "t").count() == 5
    sinks.publish(spark.range(7), base, "t", dt.datetime(2024, 1, 2))
    sinks.publish(sinks.read_current(spark, base, "t").where("id < 6").drop("dw_refreshed_at"), base, "t", run)  # a plan on the current version
    assert sinks.read_current(spark, base, "t").count() == 6
    assert [spark.read.parquet(p).count() for p in (first, second)] == [3, 5]  # old versions untouched


def test_build_again_publishes_changed_input(spark, tmpdir_path, monkeypatch):
    from strata import build
    rows = iter([3, 5])
    monkeypatch.setattr(build.catalog, "build", lambda wh, name: spark.range(next(rows)))
    one, two = (build.publish_tables(None, tmpdir_path, ["t"])["t"] for _ in range(2))
    assert one != two and [spark.read.parquet(p).count() for p in (one, two)] == [3, 5]
    assert sinks.read_current(spark, tmpdir_path, "t").count() == 5
