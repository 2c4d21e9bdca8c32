"""Stream = batch, and a restart from the checkpoint reads nothing twice."""
import datetime as dt
import json
import os
import tempfile

from strata.streaming import ingest
from strata.streaming import telemetry as T


def _write_readings(path, rows, name):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, name), "w") as fh:
        for n, ts, v, l, f in rows:
            fh.write(json.dumps({"node_id": n, "timestamp": ts, "voltage_kv": v, "load_pct": l,
                                 "frequency_hz": f}) + "\n")


def test_alert_stream_equals_batch_and_restarts(spark):
    base = tempfile.mkdtemp(prefix="strata-stream-")
    src, sink, ckpt = (os.path.join(base, x) for x in ("in", "out", "ckpt"))
    rows = [("node-substation-north", f"2024-01-01 00:00:0{i}", 132.0 + i * 5, 80.0 + i * 4, 50.0 + i * 0.2)
            for i in range(6)]
    _write_readings(src, rows, "a.json")
    q = T.alert_stream(spark, src, sink, ckpt)
    q.awaitTermination()
    streamed = sorted((r.node_id, r.severity, len(r.issues)) for r in spark.read.parquet(sink).collect())
    batch_df = spark.read.schema(T.READING_SCHEMA).json(src)
    batch = sorted((r.node_id, r.severity, len(r.issues))
                   for r in T.alerts(T.evaluate_readings(batch_df, T.node_dim(spark))).collect())
    assert streamed == batch and len(batch) > 0
    # restart with no new files: nothing is added
    T.alert_stream(spark, src, sink, ckpt).awaitTermination()
    assert spark.read.parquet(sink).count() == len(batch)


def test_raw_stream_ingest_once(spark):
    base = tempfile.mkdtemp(prefix="strata-ingest-")
    land, table, ckpt = (os.path.join(base, x) for x in ("land", "raw", "ckpt"))
    os.makedirs(land)
    with open(os.path.join(land, "p1.json"), "w") as fh:
        fh.write('{"payment_id": "P1", "order_id": "1", "amount": 10.5}\n')
        fh.write('not json\n')
        fh.write('{"payment_id": "P2", "order_id": "2", "amount": 3}\n')
    ingest.stream_raw(spark, "payments", land, table, ckpt).awaitTermination()
    ingest.stream_raw(spark, "payments", land, table, ckpt).awaitTermination()
    got = sorted((r.src_payment_id, r.src_order_id) for r in spark.read.parquet(table).collect())
    assert got == [("P1", "1"), ("P2", "2")]
    bad = spark.read.parquet(table + "_quarantine").collect()
    assert [(r._corrupt_record, r.file_name.rsplit("/", 1)[1]) for r in bad] == [("not json", "p1.json")]


def test_raw_stream_retry_leaves_one_copy(spark):
    base = tempfile.mkdtemp(prefix="strata-retry-")
    land, table, ckpt = (os.path.join(base, x) for x in ("land", "raw", "ckpt"))
    os.makedirs(land)
    with open(os.path.join(land, "p1.json"), "w") as fh:
        fh.write('{"payment_id": "P1", "order_id": "1"}\n')

    def fail(batch, epoch):
        raise RuntimeError("lost after the write")

    q = ingest.stream_raw(spark, "payments", land, table, ckpt, on_batch=fail)
    try:
        q.awaitTermination()
    except Exception:
        pass
    ingest.stream_raw(spark, "payments", land, table, ckpt).awaitTermination()
    assert spark.read.parquet(table).count() == 1
