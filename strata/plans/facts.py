"""Gold facts F11-F25.

Dimension joins: stores are hinted for broadcast (bounded by the number of
locations); every other dimension grows with the business and is left to the
planner (AQE broadcasts it only when the measured side is small, otherwise a
sort-merge join with skew splitting).  Facts that aggregate (F21, F24, F25)
pre-aggregate before any join so a hot customer/store is combined map-side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.compat import date_key, pct, second_diff
from strata.operators.joins import BOUND_STORES, bounded_broadcast
from strata.operators.keys import assign_keys


def _one_each(dim: DataFrame, key: str, *values: str) -> DataFrame:
    """One row a key.  The key is the table's own, so its rows stay as they are, but grouped by it the planner knows:
    a left join of which no column is read is dropped, and the fact is not shuffled for it."""
    return dim.groupBy(key).agg(*[F.max(v).alias(v) for v in values])


def _cur_customers(dim_customers: DataFrame) -> DataFrame:
    """LEFT JOIN ... ON id = id AND is_current = TRUE == filter first, then join."""
    cur = dim_customers.filter(F.col("is_current")).select(F.col("customer_id").alias("_c_id"), "customer_sk")
    return _one_each(cur, "_c_id", "customer_sk")


def _stores(dim_stores: DataFrame) -> DataFrame:
    return bounded_broadcast(dim_stores.select(F.col("store_id").alias("_st_id"), "store_sk"), BOUND_STORES)


def _order_keys(orders: DataFrame) -> DataFrame:
    keys = orders.select(F.col("order_id").alias("_o_id"), "order_sk", F.col("order_date").alias("_o_date"))
    return _one_each(keys, "_o_id", "order_sk", "_o_date")


def fact_sales(orders, dim_customers, dim_stores, dim_promotions) -> DataFrame:
    """one row per order."""
    promo = dim_promotions.select(F.col("promotion_id").alias("_p_id"), "promotion_sk")
    j = (orders.join(_cur_customers(dim_customers), orders.customer_id == F.col("_c_id"), "left")
         .join(_stores(dim_stores), orders.store_id == F.col("_st_id"), "left")
         .join(promo, orders.promotion_id == F.col("_p_id"), "left"))
    return j.select(
        "order_sk", date_key("order_date").alias("date_sk"), "customer_sk", "store_sk", "promotion_sk",
        "order_id", "customer_id", "store_id", "promotion_id", "channel", "order_status", "currency_code",
        "subtotal_amount", "discount_amount", "tax_amount", "shipping_amount", "total_amount",
        (F.col("total_amount") - F.col("discount_amount")).alias("net_revenue"),
        "is_first_order", "order_date", "order_timestamp")


def fact_returns(returns, orders, dim_customers) -> DataFrame:
    """F12."""
    j = (returns.join(_order_keys(orders), returns.order_id == F.col("_o_id"), "left")
         .join(_cur_customers(dim_customers), returns.customer_id == F.col("_c_id"), "left"))
    return j.select(
        "return_sk", date_key("return_date").alias("date_sk"), "customer_sk", "order_sk",
        "return_id", "order_id", "customer_id", "return_date", "return_reason", "return_status",
        "refund_amount", "refund_method", "items_count",
        F.datediff("return_date", "_o_date").cast("bigint").alias("days_to_return"))


def fact_inventory(inventory, dim_products, dim_suppliers) -> DataFrame:
    """the supplier join key comes from the joined product."""
    p = dim_products.select(F.col("product_id").alias("_p_id"), "product_sk", F.col("supplier_id").alias("_p_sup"),
                            F.col("unit_cost").alias("_cost"))
    s = dim_suppliers.select(F.col("supplier_id").alias("_s_id"), "supplier_sk")
    j = (inventory.join(p, inventory.product_id == F.col("_p_id"), "left")
         .join(s, F.col("_p_sup") == F.col("_s_id"), "left"))
    avail = F.col("quantity_available")
    return j.select(
        "inventory_sk", date_key("snapshot_date").alias("date_sk"), "product_sk", "supplier_sk",
        "product_id", "location_id", "location_type", "quantity_on_hand", "quantity_reserved",
        "quantity_available", "reorder_point", "reorder_quantity", "snapshot_date", "snapshot_timestamp",
        F.coalesce(avail <= F.col("reorder_point"), F.lit(False)).alias("is_below_reorder"),
        F.coalesce(avail == 0, F.lit(False)).alias("is_out_of_stock"),
        (F.col("_cost") * F.col("quantity_on_hand")).cast("decimal(18,4)").alias("inventory_value"))


def fact_web_sessions(ws, dim_customers, dim_campaigns) -> DataFrame:
    """F14."""
    cam = dim_campaigns.select(F.col("campaign_id").alias("_cam_id"), "campaign_sk")
    j = (ws.join(_cur_customers(dim_customers), ws.customer_id == F.col("_c_id"), "left")
         .join(cam, ws.campaign_id == F.col("_cam_id"), "left"))
    return j.select(
        "session_sk", date_key(F.to_date("session_start")).alias("date_sk"), "customer_sk", "campaign_sk",
        "session_id", "customer_id", "device_type", "browser", "os", "channel", "campaign_id",
        "session_start", "session_end", "session_duration_sec", "page_views", "is_bounce", "converted",
        "order_id", "landing_page")


def fact_payments(pay, orders, dim_customers) -> DataFrame:
    """F15."""
    j = (pay.join(_order_keys(orders), pay.order_id == F.col("_o_id"), "left")
         .join(_cur_customers(dim_customers), pay.customer_id == F.col("_c_id"), "left"))
    return j.select(
        "payment_sk", date_key(F.to_date("payment_timestamp")).alias("date_sk"), "customer_sk", "order_sk",
        "payment_id", "order_id", "customer_id", "payment_method", "payment_status", "amount",
        "currency_code", "payment_timestamp", "is_refund", "original_payment_id")


def fact_loyalty(lp, orders, dim_customers) -> DataFrame:
    """F16."""
    j = (lp.join(_order_keys(orders), lp.order_id == F.col("_o_id"), "left")
         .join(_cur_customers(dim_customers), lp.customer_id == F.col("_c_id"), "left"))
    return j.select(
        "loyalty_sk", date_key("transaction_date").alias("date_sk"), "customer_sk", "order_sk",
        "transaction_id", "customer_id", "order_id", "transaction_type", "points_change",
        "points_balance_after", "transaction_date", "transaction_timestamp", "expiry_date", "reference_code")


def fact_order_items(oi, orders, dim_customers, dim_products, dim_stores, dim_promotions) -> DataFrame:
    """cogs, gross profit and margin (D15: guard the divisor).  What hangs on an order is joined to the orders, and
    lines meet their product while they are narrow, so that lines are shuffled twice: by product and by order."""
    o = orders.select(F.col("order_id").alias("_o_id"), F.col("customer_id").alias("o_customer_id"),
                      F.col("store_id").alias("o_store_id"), F.col("channel").alias("o_channel"),
                      F.col("order_date").alias("o_order_date"), F.col("promotion_id").alias("o_promotion_id"))
    p = dim_products.select(F.col("product_id").alias("_p_id"), "product_sk", F.col("unit_cost").alias("p_unit_cost"))
    promo = dim_promotions.select(F.col("promotion_id").alias("_pr_id"), "promotion_sk")
    o = (o.join(_cur_customers(dim_customers), F.col("o_customer_id") == F.col("_c_id"), "left")
         .join(_stores(dim_stores), F.col("o_store_id") == F.col("_st_id"), "left")
         .join(promo, F.col("o_promotion_id") == F.col("_pr_id"), "left"))
    j = oi.join(p, oi.product_id == F.col("_p_id"), "left").join(o, oi.order_id == F.col("_o_id"), "inner")
    cogs = (F.col("quantity") * F.col("p_unit_cost")).cast("decimal(18,4)")
    gp = (F.col("line_total") - cogs).cast("decimal(18,4)")
    return j.select(
        "order_item_sk", date_key("o_order_date").alias("date_sk"), "customer_sk", "product_sk", "store_sk",
        "promotion_sk", "order_id", "item_id", "product_id", F.col("o_customer_id").alias("customer_id"),
        F.col("o_store_id").alias("store_id"), F.col("o_channel").alias("channel"),
        F.col("o_order_date").alias("order_date"), "quantity", "unit_price", "discount_amount", "tax_amount",
        "line_total", F.col("p_unit_cost").alias("unit_cost"), cogs.alias("cogs"), gp.alias("gross_profit"),
        F.when(F.col("line_total") != 0, gp.cast("double") / F.col("line_total").cast("double") * 100)
         .alias("margin_pct"),
        "return_flag")


def fact_shipments(sh, orders, dim_customers) -> DataFrame:
    """two role-playing date keys."""
    j = (sh.join(_order_keys(orders), sh.order_id == F.col("_o_id"), "left")
         .join(_cur_customers(dim_customers), sh.customer_id == F.col("_c_id"), "left"))
    return j.select(
        "shipment_sk", date_key("ship_date").alias("ship_date_sk"),
        date_key("actual_delivery").alias("delivery_date_sk"), "customer_sk", "order_sk",
        "shipment_id", "order_id", "customer_id", "carrier", "tracking_number", "ship_date",
        "estimated_delivery", "actual_delivery", "shipment_status", "shipping_method", "destination_country",
        "weight_kg", "shipping_cost", "is_late", "days_to_deliver",
        F.when(F.col("actual_delivery").isNotNull(), F.datediff("actual_delivery", "estimated_delivery"))
         .cast("bigint").alias("days_late"))


def fact_reviews(rv, dim_customers, dim_products, orders) -> DataFrame:
    """F19."""
    p = _one_each(dim_products.select(F.col("product_id").alias("_p_id"), "product_sk"), "_p_id", "product_sk")
    j = (rv.join(_cur_customers(dim_customers), rv.customer_id == F.col("_c_id"), "left")
         .join(p, rv.product_id == F.col("_p_id"), "left")
         .join(_order_keys(orders), rv.order_id == F.col("_o_id"), "left"))
    return j.select(
        "review_sk", date_key("review_date").alias("date_sk"), "customer_sk", "product_sk", "order_sk",
        "review_id", "product_id", "customer_id", "order_id", "rating", "review_date",
        "is_verified_purchase", "is_flagged", "helpful_votes",
        F.coalesce(F.col("rating") >= 4, F.lit(False)).alias("is_positive"),
        F.coalesce(F.col("rating") <= 2, F.lit(False)).alias("is_negative"))


def fact_promo_usage(orders, dim_promotions, dim_customers) -> DataFrame:
    """orders that used an existing promotion."""
    promo = dim_promotions.select(F.col("promotion_id").alias("_pr_id"), "promotion_sk", "promotion_type",
                                  "discount_value")
    j = (orders.filter(F.col("promotion_id").isNotNull())
         .join(promo, F.col("promotion_id") == F.col("_pr_id"), "inner")
         .join(_cur_customers(dim_customers), F.col("customer_id") == F.col("_c_id"), "left"))
    return j.select(
        "order_sk", date_key("order_date").alias("date_sk"), "customer_sk", "promotion_sk", "order_id",
        "customer_id", "promotion_id", "promotion_type", "discount_value",
        F.col("discount_amount").alias("actual_discount_given"), "subtotal_amount", "total_amount",
        pct("discount_amount", "subtotal_amount").alias("effective_discount_pct"),
        "order_date", "is_first_order")


CART_EVENT_TYPES = ["add_to_cart", "remove_from_cart", "checkout_started"]


def fact_cart_abandonment(raw_cart, web_sessions, dim_customers) -> DataFrame:
    """sessions with cart activity that did not convert.  Cart events are
    aggregated per session first (D25: one row per session, max customer id)."""
    cs = (raw_cart.filter(F.col("event_type").isin(*CART_EVENT_TYPES))
          .groupBy(F.col("src_session_id").alias("_cs_id"))
          .agg(F.min("load_timestamp").alias("first_cart_event"), F.max("load_timestamp").alias("last_cart_event"),
               F.count(F.lit(1)).alias("cart_event_count"),
               F.sum(F.when(F.col("event_type") == "add_to_cart", 1).otherwise(0)).cast("bigint").alias("items_added"),
               F.sum(F.when(F.col("event_type") == "remove_from_cart", 1).otherwise(0)).cast("bigint")
                .alias("items_removed")))
    ws = web_sessions.filter(F.col("converted") == F.lit(False))
    j = (cs.join(ws, F.col("_cs_id") == ws.session_id, "inner")
         .join(_cur_customers(dim_customers), ws.customer_id == F.col("_c_id"), "left"))
    return j.select(
        "session_sk", date_key(F.to_date("session_start")).alias("date_sk"), "customer_sk", "session_id",
        "customer_id", "device_type", "channel", "session_start", "first_cart_event", "last_cart_event",
        "items_added", "items_removed", (F.col("items_added") - F.col("items_removed")).alias("net_items_in_cart"),
        second_diff("first_cart_event", "last_cart_event").alias("time_in_cart_sec"))


def fact_interactions(orders, returns, reviews, dim_customers) -> DataFrame:
    """order / return / review touchpoints (UNION ALL)."""
    cur = _cur_customers(dim_customers)
    o = orders.join(cur, orders.customer_id == F.col("_c_id"), "left").select(
        "customer_sk", date_key("order_date").alias("date_sk"), F.col("order_id").alias("interaction_id"),
        "customer_id", F.lit("ORDER").alias("interaction_type"), F.col("order_date").alias("interaction_date"),
        F.col("total_amount").cast("decimal(18,2)").alias("interaction_value"), "channel")
    r = returns.join(cur, returns.customer_id == F.col("_c_id"), "left").select(
        "customer_sk", date_key("return_date").alias("date_sk"), F.col("return_id").alias("interaction_id"),
        "customer_id", F.lit("RETURN").alias("interaction_type"), F.col("return_date").alias("interaction_date"),
        (-F.col("refund_amount")).cast("decimal(18,2)").alias("interaction_value"),
        F.lit(None).cast("string").alias("channel"))
    v = reviews.join(cur, reviews.customer_id == F.col("_c_id"), "left").select(
        "customer_sk", date_key("review_date").alias("date_sk"), F.col("review_id").alias("interaction_id"),
        "customer_id", F.lit("REVIEW").alias("interaction_type"), F.col("review_date").alias("interaction_date"),
        F.lit(None).cast("decimal(18,2)").alias("interaction_value"), F.lit(None).cast("string").alias("channel"))
    return o.unionByName(r).unionByName(v)


def fact_supplier_orders(po, dim_suppliers, dim_products) -> DataFrame:
    """purchase orders from the inventory feed; dense SK by (date, po).  They are numbered before they meet the
    dimensions, whose keys need not go through the sort and which a mart that does not read them leaves out."""
    s = _one_each(dim_suppliers.select(F.col("supplier_id").alias("_s_id"), "supplier_sk"), "_s_id", "supplier_sk")
    p = _one_each(dim_products.select(F.col("product_id").alias("_p_id"), "product_sk"), "_p_id", "product_sk")
    po = assign_keys(po, [F.col("order_date").asc_nulls_last(), F.col("po_number").asc_nulls_last()],
                     "supplier_order_sk")
    j = (po.join(s, po.supplier_id == F.col("_s_id"), "left")
         .join(p, po.product_id == F.col("_p_id"), "left"))
    return j.select(
        "supplier_order_sk", date_key("order_date").alias("date_sk"), "supplier_sk", "product_sk",
        "po_number", "supplier_id", "product_id", "order_date", "expected_delivery", "actual_delivery",
        "quantity_ordered", "quantity_received", "unit_cost", "total_cost", "po_status",
        F.coalesce(F.col("actual_delivery") > F.col("expected_delivery"), F.lit(False)).alias("is_late_delivery"),
        F.datediff("actual_delivery", "expected_delivery").cast("bigint").alias("delivery_variance_days"),
        (F.col("quantity_received") - F.col("quantity_ordered")).alias("quantity_variance"))


def fact_store_day(orders, dim_stores) -> DataFrame:
    """store x day KPIs (CANCELLED excluded).  Aggregated on the order
    columns first, the store key is attached afterwards (one row per group)."""
    g = (orders.filter(F.col("order_status") != "CANCELLED")
         .groupBy("store_id", "order_date")
         .agg(F.count("order_id").alias("orders_count"),          # order_id is unique in silver orders
              F.count_distinct("customer_id").alias("unique_customers"),
              F.sum("total_amount").alias("_rev"), F.sum("subtotal_amount").alias("_gross"),
              F.sum("discount_amount").alias("_disc"), F.sum("tax_amount").alias("_tax"),
              F.count("total_amount").alias("_n"),
              F.count(F.when(F.col("is_first_order"), F.col("customer_id"))).alias("new_customers"),
              F.sum(F.when(F.col("order_status") == "RETURNED", F.col("total_amount")).otherwise(0))
               .alias("_ret")))
    j = g.join(_stores(dim_stores), g.store_id == F.col("_st_id"), "left")
    return j.select(
        "store_sk", date_key("order_date").alias("date_sk"), "store_id", "order_date", "orders_count",
        "unique_customers", F.col("_rev").cast("double").alias("total_revenue"),
        F.col("_gross").cast("double").alias("gross_revenue"), F.col("_disc").cast("double").alias("total_discounts"),
        F.col("_tax").cast("double").alias("total_tax"),
        (F.col("_rev").cast("double") / F.col("_n")).alias("avg_order_value"),
        "new_customers", F.col("_ret").cast("double").alias("returned_revenue"))


def fact_employee_day(links, orders, dim_employees, dim_stores) -> DataFrame:
    """employee x store x day (links deduplicated per order, D18)."""
    o = orders.select(F.col("order_id").alias("_o_id"), "customer_id", "store_id",
                      F.col("order_date").alias("o_date"), "total_amount", "discount_amount")
    j = links.join(o, links.order_id == F.col("_o_id"), "inner")
    g = (j.groupBy("employee_id", "store_id", "o_date")
         .agg(F.count("_o_id").alias("orders_taken"),                # links are one row per order
              F.count_distinct("customer_id").alias("customers_served"),
              F.sum("total_amount").alias("_sales"), F.count("total_amount").alias("_n"),
              F.sum("discount_amount").alias("_disc")))
    e = dim_employees.filter(F.col("is_current")).select(F.col("employee_id").alias("_e_id"), "employee_sk")
    j = (g.join(e, g.employee_id == F.col("_e_id"), "left")
         .join(_stores(dim_stores), g.store_id == F.col("_st_id"), "left"))
    return j.select(
        "employee_sk", date_key("o_date").alias("date_sk"), "store_sk", "employee_id", "store_id",
        F.col("o_date").alias("order_date"), "orders_taken", "customers_served",
        F.col("_sales").cast("double").alias("total_sales_amount"),
        (F.col("_sales").cast("double") / F.col("_n")).alias("avg_transaction_value"),
        F.col("_disc").cast("double").alias("total_discounts_given"))
