"""Boundary tables for the band / CASE columns (on, just under, just over, NULL)."""
import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from strata.plans import dims, marts

AS_OF = dt.date(2024, 6, 30)


def _days_ago(n):
    return AS_OF - dt.timedelta(days=n)


def test_customer_age_and_tenure_bands(spark):
    # age = calendar-year difference (boundaries crossed), as the published definition
    rows = [("a", dt.date(2000, 1, 1), _days_ago(30)), ("b", dt.date(1999, 12, 31), _days_ago(31)),
            ("c", dt.date(1970, 1, 1), _days_ago(180)), ("d", dt.date(1969, 6, 1), _days_ago(181)),
            ("e", None, _days_ago(365)), ("f", dt.date(2010, 1, 1), _days_ago(366))]
    df = spark.createDataFrame([(i + 1, k, b, r) for i, (k, b, r) in enumerate(rows)],
                               "customer_sk long, customer_id string, date_of_birth date, registration_date date")
    for c in ["first_name", "last_name", "full_name", "email", "phone", "gender", "customer_tier"]:
        df = df.withColumn(c, F.lit(None).cast("string"))
    df = (df.withColumn("is_active", F.lit(True)).withColumn("effective_from", F.lit(None).cast("timestamp_ntz"))
            .withColumn("effective_to", F.lit(None).cast("timestamp_ntz")).withColumn("is_current", F.lit(True)))
    got = {r.customer_id: (r.age_years, r.age_band, r.tenure_band) for r in dims.dim_customers(df, AS_OF).collect()}
    assert got["a"] == (24, "18-24", "NEW")
    assert got["b"] == (25, "25-34", "DEVELOPING")
    assert got["c"] == (54, "45-54", "DEVELOPING")
    assert got["d"] == (55, "55+", "ESTABLISHED")
    assert got["e"] == (None, "UNKNOWN", "ESTABLISHED")
    assert got["f"] == (14, "18-24", "VETERAN")         # under-18 stays in the first band (as published)


def test_price_margin_size_rating_bands(spark):
    prices = ["9.99", "10", "24.99", "25", "49.99", "50", "99.99", "100", "249.99", "250", "499.99", "500"]
    margins = ["59.9999", "60", "29.9999", "30", None, "0", "60", "30", "0", "59", "61", None]
    cols = ("product_sk product_id sku product_name brand category_id category_name parent_category_name "
            "top_category_name category_path supplier_id supplier_name").split()
    data = [tuple([i] + [str(i)] * (len(cols) - 1) + [Decimal("1"), Decimal(p), Decimal(m) if m else None, True,
                                                        False, Decimal("1")])
            for i, (p, m) in enumerate(zip(prices, margins))]
    schema = ", ".join([f"{c} {'long' if c == 'product_sk' else 'string'}" for c in cols]) + \
        ", unit_cost decimal(18,4), unit_price decimal(18,4), margin_pct decimal(8,4), is_active boolean, " \
        "is_digital boolean, weight_kg decimal(10,4)"
    got = [(r.price_band, r.margin_band) for r in
           dims.dim_products(spark.createDataFrame(data, schema)).orderBy("product_sk").collect()]
    assert [g[0] for g in got] == ["UNDER_$10", "$10-$25", "$10-$25", "$25-$50", "$25-$50", "$50-$100", "$50-$100",
                                   "$100-$250", "$100-$250", "$250-$500", "$250-$500", "OVER_$500"]
    assert [g[1] for g in got] == ["MEDIUM", "HIGH", "LOW", "MEDIUM", "LOW", "LOW", "HIGH", "MEDIUM", "LOW",
                                   "MEDIUM", "HIGH", "LOW"]
    st = spark.createDataFrame([(i, f"S{i}", sq, dt.date(2020, 1, 1)) for i, sq in enumerate([2999, 3000, 9999, 10000, None])],
                               "store_sk long, store_id string, square_footage long, opening_date date")
    for c in ["store_name", "store_type", "address_line1", "city", "state_province", "postal_code", "country_code",
              "timezone", "store_manager_id"]:
        st = st.withColumn(c, F.lit(None).cast("string"))
    st = (st.withColumn("latitude", F.lit(0.0)).withColumn("longitude", F.lit(0.0))
            .withColumn("closing_date", F.lit(None).cast("date")).withColumn("is_active", F.lit(True)))
    sizes = [r.size_category for r in dims.dim_stores(st, AS_OF).orderBy("store_sk").collect()]
    assert sizes == ["SMALL", "MEDIUM", "MEDIUM", "LARGE", "SMALL"]
    sup = spark.createDataFrame([(i, str(i), Decimal(r) if r else None) for i, r in
                                 enumerate(["4.5", "4.4", "3.5", "3.4", "2.5", "2.4", None])],
                                "supplier_sk long, supplier_id string, supplier_rating decimal(3,1)")
    for c in ["supplier_name", "contact_name", "email", "phone", "country", "region"]:
        sup = sup.withColumn(c, F.lit(None).cast("string"))
    sup = (sup.withColumn("payment_terms_days", F.lit(30).cast("bigint")).withColumn("lead_time_days", F.lit(5).cast("bigint"))
              .withColumn("is_active", F.lit(True)))
    labels = [r.supplier_status_label for r in dims.dim_suppliers(sup).orderBy("supplier_sk").collect()]
    assert labels == ["PREFERRED", "APPROVED", "APPROVED", "CONDITIONAL", "CONDITIONAL", "PROBATION", "PROBATION"]


def _orders(spark, rows):
    return spark.createDataFrame(
        [(oid, cid, d, "DELIVERED", Decimal(t), "WEB") for oid, cid, d, t in rows],
        "order_id string, customer_id string, order_date date, order_status string, total_amount decimal(18,2), "
        "channel string")


def _dim_customers(spark, ids):
    return spark.createDataFrame([(i + 1, c, c, "BRONZE", None, True) for i, c in enumerate(ids)],
                                 "customer_sk long, customer_id string, full_name string, customer_tier string, "
                                 "registration_date date, is_current boolean")


def test_ltv_churn_risk_and_clv_tier(spark):
    rows = [("1", "a", _days_ago(30), "499.99"), ("2", "b", _days_ago(31), "500"), ("3", "c", _days_ago(90), "2499.99"),
            ("4", "d", _days_ago(91), "2500"), ("5", "e", _days_ago(180), "9999.99"), ("6", "f", _days_ago(181), "10000")]
    o = _orders(spark, rows)
    r = spark.createDataFrame([], "return_id string, order_id string, refund_amount decimal(18,2)")
    got = {x.customer_id: (x.churn_risk, x.clv_tier, x.order_value_stddev, x.customer_lifespan_days, x.orders_per_year)
           for x in marts.customer_ltv(o, r, _dim_customers(spark, "abcdef"), AS_OF).collect()}
    assert got["a"] == ("LOW", "BRONZE", None, 0, 1.0)          # single order: lifespan 0, stddev NULL
    assert got["b"][:2] == ("MEDIUM", "SILVER")
    assert got["c"][:2] == ("MEDIUM", "SILVER")
    assert got["d"][:2] == ("HIGH", "GOLD")
    assert got["e"][:2] == ("HIGH", "GOLD")
    assert got["f"][:2] == ("CHURNED", "PLATINUM")


def test_churn_score_and_segment(spark):
    # (customer, recency days, number of orders, sessions in the last 90 days)
    cases = [("a", 90, 4, 3), ("b", 91, 3, 2), ("c", 180, 1, 0), ("d", 181, 4, 3), ("e", 365, 2, 1), ("f", 366, 1, 0)]
    rows = []
    for c, rec, n, _ in cases:
        for i in range(n):
            rows.append((f"{c}{i}", c, _days_ago(rec + 10 * i), "100"))
    o = _orders(spark, rows)
    sess = []
    for c, _, _, s in cases:
        for i in range(s):
            sess.append((f"s-{c}-{i}", c, dt.datetime.combine(_days_ago(5), dt.time(12))))
    ws = spark.createDataFrame(sess, "session_id string, customer_id string, session_start timestamp_ntz")
    got = {x.customer_id: (x.churn_score, x.churn_segment, x.avg_days_between_orders)
           for x in marts.churn_indicators(o, ws, _dim_customers(spark, "abcdef"), AS_OF).collect()}
    assert got["a"] == (0, "ACTIVE", 10.0)
    assert got["b"] == (20 + 15 + 10, "AT_RISK", 10.0)
    assert got["c"] == (20 + 25 + 15, "HIGH_RISK", None)
    assert got["d"] == (35, "HIGH_RISK", 10.0)
    assert got["e"] == (35 + 15 + 10, "HIGH_RISK", 10.0)
    assert got["f"] == (90, "CHURNED", None)                    # 50 + 25 + 15, capped at 100


def test_inventory_status(spark):
    snap = AS_OF
    # product, on hand, available, reorder point
    inv = [("p0", 10, 0, 5), ("p1", 10, -2, 5), ("p2", 20, 5, 5), ("p3", 400, 181, 5), ("p4", 400, 180, 5),
           ("p5", 60, 10, 5), ("p6", 40, 30, 5), ("p7", 60, 30, 5)]
    fi = spark.createDataFrame([(p, "L", "WAREHOUSE", oh, 0, av, rp, 100, snap, Decimal("1"), av == 0, av <= rp)
                                for p, oh, av, rp in inv],
                               "product_id string, location_id string, location_type string, quantity_on_hand long, "
                               "quantity_reserved long, quantity_available long, reorder_point long, "
                               "reorder_quantity long, snapshot_date date, inventory_value decimal(18,4), "
                               "is_out_of_stock boolean, is_below_reorder boolean")
    # daily velocity = units / days since first sale in the 90-day window
    # p5: 1 unit in 11 days -> 0.09/day, cover 110 days -> slow mover; p7: no sales (NULL velocity)
    sales = [("p3", 10, 10), ("p4", 10, 10), ("p5", 1, 11), ("p6", 10, 10)]
    foi = spark.createDataFrame([(p, q, _days_ago(d)) for p, q, d in sales],
                                "product_id string, quantity long, order_date date")
    dp = spark.createDataFrame([(p, p, "b", "c", "s") for p, *_ in inv],
                               "product_id string, product_name string, brand string, category_name string, "
                               "supplier_name string")
    got = {r.product_id: r.inventory_status for r in marts.inventory_health(fi, foi, dp, AS_OF).collect()}
    assert got == {"p0": "STOCKOUT", "p1": "LOW_STOCK", "p2": "LOW_STOCK", "p3": "OVERSTOCK", "p4": "HEALTHY",
                   "p5": "SLOW_MOVER", "p6": "HEALTHY", "p7": "HEALTHY"}
