"""Raw landing: JSON/CSV/parquet into variant payloads, bad rows quarantined."""
import os
import tempfile

from pyspark.sql import functions as F

from strata.sources import raw


def test_json_lines_array_and_bad_line(spark):
    d = tempfile.mkdtemp(prefix="strata-raw-")
    with open(os.path.join(d, "a.json"), "w") as fh:
        fh.write('{"order_id": "1", "total": "12.50"}\n')
        fh.write('{"order_id": \n')
        fh.write('[{"order_id": "2"}, {"order_id": "3"}]\n')
    good, bad = raw.land(spark, "orders", d, "b1", "2024-01-01 00:00:00")
    assert sorted(r.src_order_id for r in good.collect()) == ["1", "2", "3"]
    assert bad.count() == 1
    assert good.select("file_name").distinct().count() == 1
    # load-once: files already landed are skipped
    again, _ = raw.land(spark, "orders", d, "b2", "2024-01-02 00:00:00", already_loaded=good)
    assert again.count() == 0


def test_csv_null_tokens(spark):
    d = tempfile.mkdtemp(prefix="strata-csv-")
    with open(os.path.join(d, "s.csv"), "w") as fh:
        fh.write('store_id,name,type\nS1,"Main, North",N/A\nS2,NULL,OUTLET\n')
    df = raw.read_csv_raw(spark, d)
    got = sorted((r.s, r.n, r.t) for r in df.select(
        F.try_variant_get("payload", "$.store_id", "string").alias("s"),
        F.try_variant_get("payload", "$.name", "string").alias("n"),
        F.try_variant_get("payload", "$.type", "string").alias("t")).collect())
    assert got == [("S1", "Main, North", None), ("S2", None, "OUTLET")]


def test_parquet_row_numbers(spark):
    d = tempfile.mkdtemp(prefix="strata-pq-")
    spark.range(5).coalesce(1).withColumnRenamed("id", "supplier_id").write.mode("overwrite").parquet(d)
    df = raw.read_parquet_raw(spark, d)
    assert sorted(r.file_row_number for r in df.collect()) == [0, 1, 2, 3, 4]


def test_same_base_name_in_two_folders_and_malformed_csv(spark, tmp_path):
    import datetime as dt
    for day in ("d1", "d2"):
        (tmp_path / day).mkdir()
        (tmp_path / day / "part-0.json").write_text('{"order_id": "%s"}\n' % day)
    run = dt.datetime(2024, 1, 1)
    first, _ = raw.land(spark, "orders", str(tmp_path / "d1"), "b1", run)
    again, _ = raw.land(spark, "orders", str(tmp_path / "d*"), "b2", run, already_loaded=first)
    assert [r.src_order_id for r in again.collect()] == ["d2"]
    (tmp_path / "c.csv").write_text("employee_id,name\nE1,Ann\nE2,Bob,extra,more\nE3,N/A\n")
    good, bad = raw.land(spark, "employees", str(tmp_path / "c.csv"), "b1", run)
    assert sorted(r.src_employee_id for r in good.collect()) == ["E1", "E3"]
    assert [r._corrupt_record for r in bad.collect()] == ["E2,Bob,extra,more"]
