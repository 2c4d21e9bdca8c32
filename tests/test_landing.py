"""Arrays of records, by batch and stream, and row numbers over several splits of a file."""
import json
import os
import tempfile

from strata.sources import raw
from strata.streaming import ingest


def _files(**texts):
    land = os.path.join(tempfile.mkdtemp(prefix="strata-land-"), "land")
    os.makedirs(land)
    for name, text in texts.items():
        with open(os.path.join(land, f"{name}.json"), "w") as f:
            f.write(text)
    return land


def _seen(rows):
    return sorted((r["src_payment_id"], r["file_name"].rsplit("/", 1)[1], r["file_row_number"]) for r in rows)


def _streamed(spark, land, **options):
    base = tempfile.mkdtemp(prefix="strata-land-out-")
    run = lambda: ingest.stream_raw(spark, "payments", land, f"{base}/raw", f"{base}/ckpt", **options).awaitTermination()
    run()
    run()
    return spark.read.parquet(f"{base}/raw").collect(), spark.read.parquet(f"{base}/raw_quarantine").collect()


def _batch(spark, land, **options):
    good, bad = raw.split_bad(raw.read_json_raw(spark, land, **options))
    return raw.lift_keys(good, raw.SOURCES["payments"].keys).collect(), bad.collect()


def test_array_over_lines_stream_equals_batch(spark):
    records = [{"payment_id": f"P{i}", "order_id": str(i)} for i in range(5)]
    land = _files(a=json.dumps(records, indent=2), b=json.dumps(records[0]), c="[]", d="[1, ")
    want = sorted([(f"P{i}", "a.json", i) for i in range(5)] + [("P0", "b.json", 0)])
    for rows, bad in (_batch(spark, land, multi_line=True), _streamed(spark, land, multi_line=True)):
        assert _seen(rows) == want
        assert [(r["file_name"].rsplit("/", 1)[1], r["file_row_number"]) for r in bad] == [("d.json", 0)]


def test_array_in_a_line(spark):
    land = _files(a='[{"payment_id": "P1"}, {"payment_id": "P2"}]\n[]\n{"payment_id": "P3"}\nnot json\n[{"payment_id": "P4"}]\n')
    for rows, bad in (_batch(spark, land), _streamed(spark, land)):
        assert _seen(rows) == [("P1", "a.json", 0), ("P2", "a.json", 1), ("P3", "a.json", 2), ("P4", "a.json", 4)]
        assert [(r["_corrupt_record"], r["file_row_number"]) for r in bad] == [("not json", 3)]


def test_row_numbers_over_splits(spark):
    n = 4000
    land = _files(a="".join("broken\n" if i % 7 == 0 else json.dumps({"payment_id": f"A{i}"}) + "\n" for i in range(n)), b='{"payment_id": "B0"}\n')
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8000")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        assert spark.read.text(land).rdd.getNumPartitions() > 3
        rows, bad = _batch(spark, land)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert {(r["src_payment_id"], r["file_row_number"]) for r in rows} == {(f"A{i}", i) for i in range(n) if i % 7} | {("B0", 0)}
    assert sorted(r["file_row_number"] for r in bad) == list(range(0, n, 7))


def test_no_rows(spark):
    assert _batch(spark, _files(a="", b="[]")) == ([], [])
