"""Silver jobs on raw JSON with the edge rows every payload fixture must hold."""
import datetime as dt
import os
import tempfile

from pyspark.sql import functions as F

from strata.plans import silver
from strata.sources import raw

T1 = dt.datetime(2024, 1, 1, 1)
T2 = dt.datetime(2024, 1, 1, 2)


def _land(spark, source, lines, run_ts, batch):
    d = tempfile.mkdtemp(prefix=f"strata-{source}-")
    with open(os.path.join(d, "f.json"), "w") as fh:
        fh.write("\n".join(lines) + "\n")
    good, bad = raw.land(spark, source, d, batch, run_ts)
    return good, bad


def test_orders_edge_rows(spark):
    r1, bad = _land(spark, "orders", [
        '{"order_id": "1", "customer_id": "c1", "status": "pending", "total": "10.005", "order_date": "2024-01-01"}',
        '{"order_id": null, "status": "pending"}',                       # JSON-null key -> rejected
        '{"status": "pending"}',                                          # no key -> rejected
        '{"order_id": "2", "customer_id": "c1", "total": "abc", "order_date": "not a date", "channel": ""}',
        '{"order_id": "3", "customer_id": "c2", "discount": "", "total": 5, "order_date": "2024-01-02", "promotion_id": "NULL"}',
        '{"order_id": ',                                                  # malformed -> quarantine
    ], T1, "b1")
    assert bad.count() == 1
    v1 = silver.s02_orders(r1, None, T1)
    got = {r.order_id: r for r in v1.collect()}
    assert sorted(got) == ["1", "2", "3"]
    assert str(got["1"].total_amount) == "10.01"                          # NUMBER(18,2) rounds half up
    assert got["2"].total_amount is None and got["2"].order_date is None  # soft casts
    assert got["2"].channel == "WEB"                                      # '' is a null token -> default
    assert str(got["3"].discount_amount) == "0.00" and got["3"].currency_code == "USD"
    assert got["3"].promotion_id is None                                  # 'NULL' token
    assert got["1"].is_first_order and not got["2"].is_first_order      # D5: first by (timestamp, id)
    # a later load with a new status updates only the type-1 columns
    r2, _ = _land(spark, "orders", ['{"order_id": "1", "customer_id": "cX", "status": "shipped", "total": 11}'],
                  T2, "b2")
    v2 = {r.order_id: r for r in silver.s02_orders(r2, v1, T2).collect()}
    assert v2["1"].order_status == "SHIPPED" and str(v2["1"].total_amount) == "11.00"
    assert v2["1"].customer_id == "c1" and v2["1"].order_sk == got["1"].order_sk


def test_whole_numbers_round_half_away_from_zero(spark):
    r, _ = _land(spark, "order_items", [
        '{"order_id": "1", "item_id": "1", "quantity": "1.5"}', '{"order_id": "1", "item_id": "2", "quantity": 2.5}',
        '{"order_id": "1", "item_id": "3", "quantity": "abc"}', '{"order_id": "1", "item_id": "4", "quantity": 7}',
    ], T1, "b1")
    got = {x.item_id: x.quantity for x in silver.s03_order_items(r, None, T1).collect()}
    assert got == {"1": 2, "2": 3, "3": 1, "4": 7}                        # unparseable -> default 1


def test_customers_type2_null_to_value_and_duplicates(spark):
    r1, _ = _land(spark, "customers", [
        '{"customer_id": "1", "first_name": " Ann ", "last_name": "Lee", "email": " A@X.COM ", "phone": null, '
        '"tier": "gold", "date_of_birth": "1990-02-30", "is_active": "maybe"}',
        '{"customer_id": "2", "first_name": "Bo", "last_name": "Ng", "email": "b@x.com", "phone": "(555) 1-2"}',
    ], T1, "b1")
    v1 = silver.s01_customers(r1, None, T1)
    c = {r.customer_id: r for r in v1.collect()}
    assert c["1"].full_name == "Ann Lee" and c["1"].email == "a@x.com" and c["1"].customer_tier == "GOLD"
    assert c["1"].date_of_birth is None and c["1"].is_active is None    # bad date / bool text -> NULL
    assert c["2"].phone == "55512" and c["2"].customer_tier == "BRONZE"
    r2, _ = _land(spark, "customers", [
        '{"customer_id": "1", "first_name": "Ann", "last_name": "Lee", "email": "a@x.com", "phone": "+1 555", '
        '"tier": "gold"}',                                              # phone NULL -> value: a change (D3)
        '{"customer_id": "2", "first_name": "Bo", "last_name": "Ng", "email": "old@x.com", "phone": "(555) 1-2"}',
    ], T2, "b2")
    # an older duplicate of key 2 (loaded before run 1) must not win (SV1 + D4)
    r2b = r2.withColumn("load_timestamp", F.when(F.col("src_customer_id") == "2",
                                                 F.lit(dt.datetime(2023, 12, 31)).cast("timestamp_ntz"))
                        .otherwise(F.col("load_timestamp")))
    v2 = silver.s01_customers(r1.unionByName(r2b), v1, T2)
    rows = sorted(((r.customer_id, r.phone, r.is_current) for r in v2.collect()), key=str)
    assert rows == sorted([("1", None, False), ("1", "+1555", True), ("2", "55512", True)], key=str)
