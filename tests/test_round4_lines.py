"""Line items are spread by order, purchase orders are made once, and cheap reads of text give what the plain ones do."""
import os

import pytest
from pyspark.sql import functions as F

from strata.functions.compat import money, money4
from strata.plans import silver
from strata.plans.warehouse import Warehouse
from strata.sources import feeds

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.exists(SF), reason="test tables not present")


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_lines_are_shuffled_once_before_they_are_grouped(spark):
    grouped = {"l_orderkey": feeds.dedup_lines(spark, SF), "l_orderkey#": feeds._line_sums(spark, SF)}
    for df in grouped.values():
        plan = _plan(df)
        assert plan.count("Exchange hashpartitioning(l_orderkey") == plan.count("Exchange ") == 1, plan
    assert "Exchange hashpartitioning(l_orderkey" in _plan(feeds.raw_order_items(spark, SF))


def test_purchase_orders_are_not_made_again_by_the_range_sort(spark):
    wh = Warehouse(spark, SF)
    assert "to_variant_object" not in _plan(wh.purchase_orders)
    assert wh.purchase_orders.count() == wh.fact_supplier_orders.count() > 0


NUMBERS = ["12.345", "-12.345", "0.005", "-0.0", ".5", "5.", "+7", " 8.125 ", "1e3", "1.0E7", "1E-5", "abc", "", None, "1.5d", "0x1p3",
           "123456789012.125", "12345678901234.56789", "1.00000000000000049", "١٢", "1,5", "--1", "0.99995", "000000000001.5"]


@pytest.mark.parametrize("to", [money, money4])
@pytest.mark.parametrize("default", [None, 0.0])
def test_money_of_text_is_that_of_its_double(spark, to, default):
    rows = spark.createDataFrame([(n,) for n in NUMBERS], "v string").select(F.to_variant_object(F.struct("v")).alias("payload"))
    old = silver.vdbl("v") if default is None else F.coalesce(silver.vdbl("v"), F.lit(default))
    out = silver._select(rows, silver.vs("v").alias("text"), silver.vmoney("v", to, default).alias("new"), to(old).alias("old"))
    assert [r for r in out.collect() if r["new"] != r["old"]] == []
    assert out.where("old is not null").count() >= 16


def test_dates_of_text_are_those_of_the_pattern(spark):
    texts = ["2001-08-01", "2001-8-1", "2001-08", "2001", "2001-02-30", "0001-01-01", "9999-12-31", " 2001-08-01", "2001-08-01 ", "2001-8-01 ",
             "2001-08-01T01:00:00", "20010801", "", None, "x", "+2001-08-01", "10000-01-01", "1582-10-10"]
    rows = spark.createDataFrame([(n,) for n in texts], "v string").select(F.to_variant_object(F.struct("v")).alias("payload"))
    old = F.try_to_timestamp(silver._text("v"), F.lit("yyyy-MM-dd")).cast("date")
    out = silver._select(rows, silver.vdate("v").cast("string").alias("new"), old.cast("string").alias("old"))
    assert [r for r in out.collect() if r["new"] != r["old"]] == []


def test_product_of_cents_is_the_decimal_one(spark):
    values = [0.0, -0.0, 0.07, 1.005, 84197.04, -3.1, 1e-9, 99999999.99, 1234567890123.45, 0.1, 0.29, None]
    df = spark.createDataFrame([(a, b) for a in values for b in values], "a double, b double")
    exact = (F.col("a").cast("decimal(18,2)") * F.col("b").cast("decimal(18,2)")).cast("double")
    out = df.select("a", "b", feeds._cents_product("a", "b").cast("string").alias("new"), exact.cast("string").alias("old"))
    assert [r for r in out.collect() if r["new"] != r["old"]] == []
