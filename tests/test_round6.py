"""What a written table leaves on disk, and marts that shuffle no column, row or dimension they need not."""
import os
import time

import pytest
from pyspark.sql import functions as F

from strata.plans import marts
from strata.plans.warehouse import Warehouse
from strata.session import publish_once

SF = "/root/testdata/sf0.001"


def _optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.fixture(scope="module")
def wh(spark):
    if not os.path.exists(SF):
        pytest.skip("test tables not present")
    return Warehouse(spark, SF)


def _shuffle_files(spark) -> set[str]:
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_")}


def test_a_published_table_leaves_no_shuffle_files(spark):
    rows = spark.range(50_000).withColumn("k", F.xxhash64("id") % 1000).repartition("k")
    before, setting = _shuffle_files(spark), spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", None)
    kept = publish_once(rows.groupBy("k").agg(F.max("id").alias("top")))
    for _ in range(50):
        left = _shuffle_files(spark) - before
        if not left:
            break
        time.sleep(0.2)
    assert not left and kept.agg(F.sum("top")).first()[0] == rows.groupBy("k").agg(F.max("id").alias("top")).agg(F.sum("top")).first()[0]
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", None) == setting


# ------------------------------------------------------------------ M37, F23
def _purchases(spark):
    sup = spark.createDataFrame([("s1", 1), ("s2", 2), ("s3", 3)], "supplier_id string, supplier_sk long")
    sup = sup.selectExpr("*", "'n' supplier_name", "'c' country", "'r' region", "1.5D supplier_rating", "'A' supplier_status_label",
                         "30L payment_terms_days", "5L lead_time_days")
    rows = [("s1", "PO1", "p1", False), ("s1", "PO1", "p2", True), ("s1", "PO2", "p2", False), ("s1", None, "p2", True),
            ("s2", "PO1", "p1", True), ("s2", "PO3", None, False), ("s9", "PO4", "p1", True), (None, "PO5", "p1", False)]
    fso = spark.createDataFrame(rows, "supplier_id string, po_number string, product_id string, is_late_delivery boolean")
    fso = fso.selectExpr("*", "2L quantity_ordered", "1L quantity_received", "3.5D total_cost", "DATE'2001-01-03' actual_delivery",
                         "DATE'2001-01-01' order_date", "2L delivery_variance_days")
    foi = spark.createDataFrame([("o1", "p1"), ("o1", "p2"), ("o1", "p2"), ("o2", "p2")], "order_id string, product_id string")
    fr = spark.createDataFrame([("r1", "o1"), ("r2", "o1"), ("r3", "o2")], "return_id string, order_id string")
    return sup, fso, foi, fr


def test_supplier_counts_are_distinct(spark):
    got = {r["supplier_id"]: r for r in marts.supplier_performance(*_purchases(spark)).collect()}
    cols = ["total_po_count", "late_deliveries", "distinct_products", "returns_from_supplier_products", "total_units_ordered", "total_spend"]
    assert {s: tuple(r[c] for c in cols) for s, r in got.items()} == {
        "s1": (2, 1, 2, 3, 8, 14.0), "s2": (2, 1, 1, 2, 4, 7.0), "s3": (0, 0, 0, 0, None, None)}


def test_purchase_orders_are_not_expanded_for_distinct_counts(spark, monkeypatch):
    monkeypatch.setattr(marts, "global_rank", lambda df, *a, **k: df)
    assert "Expand" not in _optimized(marts.supplier_performance(*_purchases(spark)))


def test_purchase_orders_meet_no_dimension_that_is_not_read(wh):
    whole, part = wh.fact_supplier_orders, wh.fact_supplier_orders.select("supplier_id", "product_id", "quantity_ordered")
    assert "Join" in _optimized(whole) and "Join" not in _optimized(part)
    assert whole.count() == part.count() == wh.purchase_orders.count()


# ------------------------------------------------------------------ F17, M29
def test_order_items_are_shuffled_by_product_and_by_order_only(wh):
    keep, own = [], Warehouse.__init__.__globals__["publish_once"]
    Warehouse.__init__.__globals__["publish_once"] = lambda df, *a: keep.append(df) or own(df, *a)
    try:
        fresh = Warehouse(wh.spark, wh.sf_dir)
        fresh.fact_order_items
    finally:
        Warehouse.__init__.__globals__["publish_once"] = own
    joins = [line for line in _optimized(keep[-1]).split("\n") if "Join " in line]
    # above the lines: their order and their product; what hangs on an order is joined below, to the orders; no first order
    of_lines = [line for line in joins if "(order_id#" in line.split("Join ")[1] or "(product_id#" in line]
    assert len(of_lines) == 2 and len(joins) == 5 and "is_first_order" not in _optimized(keep[-1]), joins


def test_first_orders_are_not_looked_for_if_not_read(wh):
    assert "Aggregate" not in _optimized(wh.orders.select("order_id", "total_amount"))
    assert wh.orders.where("is_first_order").count() == wh.orders.select("customer_id").where("customer_id is not null").distinct().count()


def test_reviews_meet_no_dimension_that_is_not_read(wh):
    assert "Join" not in _optimized(wh.fact_reviews.select("product_id", "rating", "is_positive"))
    assert wh.fact_reviews.count() == wh.reviews.count()


def test_products_sums_do_not_go_with_their_orders(wh, monkeypatch):
    monkeypatch.setattr(marts, "global_positions", lambda df, *a, **k: df)
    plan = _optimized(marts.product_performance(wh.dim_products, wh.fact_order_items, wh.fact_reviews))
    groups = [line for line in plan.split("\n") if "Aggregate" in line and "order_id#" in line]
    assert groups and not [line for line in groups if "sum(" in line], groups


# ------------------------------------------------------------------ M35, and cheap reads that it shares
def _by_hand(lines, returns):
    """Slice -> (orders, revenue), (slice, reason) -> (returns, refund, days, to card)."""
    den, num, total, seen = {}, {}, {}, {}
    for o, k, v in lines:
        den.setdefault(k, [set(), 0])[0].add(o)
        den[k][1] += v
        total[o] = total.get(o, 0) + v
    for rid, o, reason, refund, method, days in returns:
        for lo, k, v in lines:
            if lo == o:
                part = (2 * refund * v + total[o]) // (2 * total[o])
                row = num.setdefault((k, reason), [0, 0, 0, 0])
                if (rid, k) not in seen:
                    seen[rid, k] = True
                    row[0], row[2] = row[0] + 1, row[2] + days
                row[1] += part
                row[3] += part if method == "ORIGINAL_PAYMENT" else 0
    return den, num


def test_return_rates_of_orders_with_many_lines_and_returns(spark):
    lines = [("o1", "a", 30), ("o1", "a", 70), ("o1", "b", 50), ("o2", "a", 10), ("o2", None, 90), ("o3", "b", 40), ("o4", "c", 5)]
    returns = [("r1", "o1", "X", 101, "ORIGINAL_PAYMENT", 3), ("r2", "o1", "X", 33, "STORE_CREDIT", 5), ("r3", "o1", "Y", 7, "STORE_CREDIT", 9),
               ("r4", "o2", "X", 55, "ORIGINAL_PAYMENT", 2), ("r5", None, "X", 1, "STORE_CREDIT", 1), ("r6", "o9", "X", 1, "STORE_CREDIT", 1)]
    foi = spark.createDataFrame([(o, k or "none", v, 20010801) for o, k, v in lines], "order_id string, product_id string, v int, date_sk long")
    foi = foi.withColumn("line_total", (F.col("v") / 1).cast("decimal(18,4)"))
    fr = spark.createDataFrame(returns, "return_id string, order_id string, return_reason string, cents int, refund_method string, days_to_return int")
    fr = fr.withColumn("refund_amount", (F.col("cents") / 100).cast("decimal(18,2)"))
    p = spark.createDataFrame([("a", "C", "T", "B1"), ("b", "C", "T", "B2"), ("c", "C", "T", "B3"), ("none", "C", "T", None)],
                              "product_id string, category_name string, top_category_name string, brand string")
    d = spark.createDataFrame([(20010801, 2001, "Q3", 8, "August")], "date_sk long, year_number long, quarter_name string, month_number long, month_name string")
    got = {(r["brand"], r["return_reason"]): r for r in marts.return_rates(fr, foi, p, d).collect()}
    den, num = _by_hand(lines, returns)
    brand = {"a": "B1", "b": "B2", "c": "B3"}
    expected = {(brand[k], reason): v for (k, reason), v in num.items() if k}
    assert set(got) == set(expected) and len(expected) == 4
    for (k, reason), (n, refund, days, card) in num.items():
        if k:
            r = got[brand[k], reason]
            assert (r["total_returns"], r["total_orders_in_period"]) == (n, len(den[k][0])), (k, reason)
            assert (int(r["total_refund_amount"] * 100), int(r["refunded_to_card"] * 100), r["avg_days_to_return"]) == (refund, card, days / n)
            assert r["revenue_return_rate_pct"] == refund / (den[k][1] * 100.0) * 100


def test_return_rates_read_lines_and_returns_once(wh):
    plan = _optimized(marts.return_rates(wh.fact_returns, wh.fact_order_items, wh.dim_products, wh.dim_date))
    scans = [line for line in plan.split("\n") if "Relation" in line]
    assert sum("order_item_sk" in line for line in scans) == 1 and sum("return_reason#" in line for line in scans) == 1, scans
    assert not [line for line in plan.split("\n") if "RepartitionByExpression" in line and "category_name" in line]


NUMBERS = ["1", "-1", "+7", " 8 ", "1.5", "2.5", "-2.5", "0.4999", "1e3", "1E-3", "5.", ".5", "", " ", None, "abc", "--1", "9223372036854775807",
           "9223372036854775808", "-9223372036854775808", "99999999999999999999999999999999999999", "1e40", "\u0661\u0662", "1 2", "0x1", "1L",
           "007", "-0", "\t9\n", "\u00a05", "1_000", "1,000", "Infinity", "NaN", "+", "-", "\x01" + "3", "4\x00"]


def test_whole_numbers_of_text_are_those_of_their_decimal(spark):
    from strata.plans import silver
    rows = spark.createDataFrame([(n,) for n in NUMBERS], "v string").select(F.to_variant_object(F.struct("v")).alias("payload"))
    old = silver._text("v").try_cast("decimal(38,0)").try_cast("bigint")
    out = silver._select(rows, silver.vs("v").alias("text"), silver.vnum("v").alias("new"), old.alias("old"))
    assert [r for r in out.collect() if r["new"] != r["old"]] == [] and out.where("old is not null").count() >= 12


def test_sums_of_products_are_the_decimal_ones(spark):
    from strata.sources import feeds
    values = [0.0, -0.0, 0.07, 1.005, 84197.04, -3.1, 1e-9, 99999999.99, 1234567890123.45, 0.1, 0.29, 0.005, None]
    pairs = [(i % 7, a, b) for i, (a, b) in enumerate((a, b) for a in values for b in values)] + [(8, None, 1.0), (9, 1.005, 1.0), (10, 0.05, 0.07)]
    df = spark.createDataFrame(pairs, "k int, a double, b double")
    exact = F.sum(F.col("a").cast("decimal(18,2)") * F.col("b").cast("decimal(18,2)"))
    for scale in ("decimal(18,2)", "decimal(38,4)"):
        rows = df.where("coalesce(abs(a * b), 0) < 1e14").groupBy("k").agg(feeds._sum_of_products("a", "b").cast(scale).alias("new"), exact.cast(scale).alias("old")).collect()
        assert len(rows) == 10 and [r for r in rows if r["new"] != r["old"]] == [], rows
