"""Benchmark: run the headline queries end to end (raw feeds -> silver ->
gold) on ``$BENCH_SF_DIR`` with ``local[$BENCH_CPUS]`` and print one JSON
line.  Each query is executed completely into Spark's ``noop`` sink (no
collect), so the time covers scan, shuffles and every operator."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from strata.plans import catalog  # noqa: E402
from strata.plans.warehouse import Warehouse  # noqa: E402
from strata.session import build_session  # noqa: E402

HEADLINE = [
    "daily_sales_summary", "monthly_revenue", "customer_lifetime_value", "product_performance",
    "category_revenue", "store_performance_monthly", "customer_churn_indicators", "net_promoter_score",
    "fulfillment_metrics", "supplier_performance", "top_customers", "fact_order_items", "silver_customers",
    "grid_alerts",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(f"local[{cpus}]", app="strata-bench", shuffle_partitions=int(cpus) * 2,
                          extra={"spark.driver.memory": "16g"})
    wh = Warehouse(spark, sf_dir)
    times = {}
    for name in HEADLINE:
        t0 = time.time()
        catalog.build(wh, name).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t0, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_total_runtime", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()
