"""Payloads are parsed once; what is made of a part is made in many tasks."""
import os

import pytest
from pyspark.sql import functions as F

from strata.plans import silver
from strata.sources import feeds

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.exists(SF), reason="test tables not present")


def _optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_a_filter_on_a_key_does_not_parse_the_payload_again(spark, monkeypatch):
    monkeypatch.setattr(silver, "assign_keys", lambda df, *a, **k: df)
    for df in (silver._latest(silver.customers_src(feeds.raw_customers(spark, SF)[0]), ["customer_id"]),
               silver._latest(silver.orders_src(feeds.raw_orders(spark, SF)), ["order_id"]),
               silver.s03_order_items(feeds.raw_order_items(spark, SF), None, feeds.RUN1)):
        plan = _optimized(df)
        assert plan.count("try_variant_get(") == 1 and plan.count("to_variant_object(") == 1, plan


def test_parsed_once_gives_null_and_kept_rows_as_before(spark):
    raw = spark.createDataFrame([(1, '{"a": "x", "b": 2}'), (2, '{"a": null}'), (3, "[1]"), (4, None)], "id int, j string")
    raw = raw.select("id", F.parse_json("j").alias("payload"))
    rows = silver._select(raw, silver.vs("a").alias("a"), silver.vnum("b").alias("b"), F.col("id")).orderBy("id").collect()
    assert [tuple(r) for r in rows] == [("x", 2, 1), (None, None, 2), (None, None, 3), (None, None, 4)]


def test_snapshots_of_one_row_group_are_made_in_many_tasks(spark):
    many = 3 * spark.sparkContext.defaultParallelism
    assert feeds.table(spark, SF, "part").rdd.getNumPartitions() == 1
    raw = feeds.raw_inventory(spark, SF).where(F.col("record_type") == feeds.SNAPSHOT)
    assert raw.rdd.getNumPartitions() == many and feeds.raw_products(spark, SF).rdd.getNumPartitions() == many
    assert raw.count() == 6 * feeds.table(spark, SF, "part").count()


def _supplier_case(spark):
    sup = spark.createDataFrame([("s1", 1), ("s2", 2), ("s3", 3)], "supplier_id string, supplier_sk long")
    fso = spark.createDataFrame([("s1", "p1"), ("s1", "p2"), ("s2", "p2"), ("s2", "p2"), ("s9", "p1"), ("s3", "p3")], "supplier_id string, product_id string")
    foi = spark.createDataFrame([("o1", "p1"), ("o1", "p2"), ("o1", "p2"), ("o2", "p2"), ("o3", "p1"), ("o4", "p3")], "order_id string, product_id string")
    fr = spark.createDataFrame([("r1", "o1"), ("r2", "o1"), ("r3", "o2"), ("r4", None), ("r5", "o8")], "return_id string, order_id string")
    return sup, fso, foi, fr


@pytest.mark.parametrize("block", [4096, 1])
def test_returns_per_supplier_count_a_return_once(spark, monkeypatch, block):
    from strata.plans import marts
    monkeypatch.setattr(marts, "SUPPLIER_BLOCK", block)
    got = marts._returns_per_supplier(*_supplier_case(spark))
    assert {r["_r_sup"]: r["_rc"] for r in got.collect()} == {"s1": 3, "s2": 3}


def test_returns_and_suppliers_are_not_shuffled_in_pairs(spark):
    from strata.plans import marts
    plan = _optimized(marts._returns_per_supplier(*_supplier_case(spark)))
    assert "distinct return_id" not in plan and "array_distinct" in plan
