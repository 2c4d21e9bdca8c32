"""Marts over line items carry narrow rows and read the lines no oftener than they must."""
import os

import pytest

from strata.plans import marts
from strata.plans.warehouse import Warehouse

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.exists(SF), reason="test tables not present")


def _plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.fixture(scope="module")
def wh(spark):
    return Warehouse(spark, SF)


def test_category_revenue_does_not_expand_lines(wh):
    df = marts.category_revenue(wh.fact_order_items, wh.dim_products, wh.dim_categories, wh.dim_date)
    assert "Expand" not in _plan(df)
    for row in (line for line in _plan(df).split("\n") if "Aggregate" in line and "order_id" in line):
        assert "category_name" not in row and "category_path" not in row, row
    assert df.count() > 0


def test_product_affinity_reads_lines_once(wh):
    df = marts.product_affinity(wh.fact_order_items, wh.dim_products, wh.dim_customers, wh.as_of)
    assert _plan(df).count("line_total") and sum("Relation" in line and "order_item_sk" in line for line in _plan(df).split("\n")) == 1
    assert df.count() > 0
