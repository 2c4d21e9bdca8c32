"""Plan guards: growing-entity marts must not funnel rows into one task, and
scans must be pruned to the columns a query needs."""
import os

import pytest

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _rows_funnelled(plan: str) -> list[str]:
    """SinglePartition exchanges that move data rows into one task.  The
    final step of a keyless aggregate (one partial row per partition) is
    allowed; anything else (a window or sort over all rows) is not."""
    lines = plan.split("\n")
    bad = []
    for i, line in enumerate(lines):
        if "Exchange SinglePartition" in line:
            child = next((l for l in lines[i + 1:] if l.strip()), "")
            if not ("HashAggregate(keys=[]" in child and "partial_" in child):
                bad.append(line.strip())
    return bad


@pytest.mark.skipif(not os.path.exists(SF), reason="test tables not present")
def test_entity_marts_have_no_single_partition_exchange(spark):
    from strata.plans import catalog
    from strata.plans.warehouse import Warehouse
    wh = Warehouse(spark, SF)
    for name in ["product_performance", "top_customers", "supplier_performance", "customer_lifetime_value",
                 "customer_churn_indicators", "product_affinity", "campaign_effectiveness", "promotion_roi",
                 "top_products", "net_promoter_score", "return_rate_analysis", "grid_outages"]:
        assert _rows_funnelled(_plan(catalog.build(wh, name))) == [], name


@pytest.mark.skipif(not os.path.exists(SF), reason="test tables not present")
def test_scan_is_pruned(spark):
    from strata.sources.feeds import table
    from strata.streaming import telemetry as T
    df = T.readings_from_events(table(spark, SF, "events")).select("node_id", "load_pct")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "props" not in plan and "event_type" not in plan
