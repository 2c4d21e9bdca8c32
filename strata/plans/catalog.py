"""Registry of published tables: name -> builder over a ``Warehouse``.

Silver tables are published without their audit columns (load stamps,
created/updated times), which hold run times rather than data."""

from __future__ import annotations

from pyspark.sql import DataFrame

from strata.plans import basket, marts
from strata.plans.warehouse import Warehouse
from strata.sources.raw import SOURCES

SILVER_COLUMNS = {
    "customers": "customer_sk customer_id first_name last_name full_name email phone date_of_birth gender "
                 "customer_tier registration_date is_active effective_from effective_to is_current",
    "orders": "order_sk order_id customer_id store_id order_date order_timestamp order_status channel currency_code "
              "subtotal_amount discount_amount tax_amount shipping_amount total_amount promotion_id is_first_order",
    "order_items": "order_item_sk order_id item_id product_id quantity unit_price discount_amount tax_amount "
                   "line_total return_flag",
    "products": "product_sk product_id sku product_name category_id supplier_id brand unit_cost unit_price weight_kg "
                "is_active is_digital effective_from effective_to is_current",
    "categories": "category_sk category_id category_name parent_category_id category_level category_path is_active",
    "suppliers": "supplier_sk supplier_id supplier_name contact_name email phone country region payment_terms_days "
                 "lead_time_days is_active supplier_rating",
    "inventory": "inventory_sk product_id location_id location_type quantity_on_hand quantity_reserved "
                 "quantity_available reorder_point reorder_quantity snapshot_date snapshot_timestamp",
    "payments": "payment_sk payment_id order_id customer_id payment_method payment_status amount currency_code "
                "payment_timestamp gateway_reference is_refund original_payment_id",
    "returns": "return_sk return_id order_id customer_id return_date return_reason return_status refund_amount "
               "refund_method items_count",
    "reviews": "review_sk review_id product_id customer_id order_id rating review_title review_body review_date "
               "is_verified_purchase is_flagged helpful_votes",
    "employees": "employee_sk employee_id first_name last_name full_name job_title department store_id manager_id "
                 "hire_date termination_date employment_status employment_type effective_from effective_to is_current",
    "stores": "store_sk store_id store_name store_type address_line1 city state_province postal_code country_code "
              "latitude longitude timezone opening_date closing_date is_active store_manager_id square_footage",
    "promotions": "promotion_sk promotion_id promotion_name promotion_type discount_value min_order_amount "
                  "max_discount_amount start_date end_date applies_to promo_code is_stackable is_active usage_limit "
                  "times_used",
    "campaigns": "campaign_sk campaign_id campaign_name campaign_type channel start_date end_date budget_amount "
                 "spend_amount target_audience impressions clicks conversions revenue_attributed is_active",
    "web_sessions": "session_sk session_id customer_id device_type browser os channel campaign_id session_start "
                    "session_end session_duration_sec page_views is_bounce converted order_id landing_page",
    "shipments": "shipment_sk shipment_id order_id customer_id carrier tracking_number ship_date estimated_delivery "
                 "actual_delivery shipment_status shipping_method origin_zip destination_zip destination_country "
                 "weight_kg shipping_cost is_late days_to_deliver",
    "addresses": "address_sk address_id customer_id address_type address_line1 address_line2 city state_province "
                 "postal_code country_code is_default is_validated latitude longitude effective_from effective_to "
                 "is_current",
    "loyalty_points": "loyalty_sk transaction_id customer_id order_id transaction_type points_change "
                      "points_balance_after transaction_date transaction_timestamp expiry_date reference_code notes",
    "customer_segments": "customer_id segment_date recency_days frequency_orders monetary_total rfm_recency_score "
                         "rfm_frequency_score rfm_monetary_score rfm_combined_score lifecycle_segment value_segment "
                         "channel_preference is_vip has_churned",
    "product_catalog": "product_sk product_id sku product_name brand category_id category_name parent_category_id "
                       "parent_category_name top_category_name category_path supplier_id supplier_name unit_cost "
                       "unit_price margin_pct is_active is_digital weight_kg",
}

GOLD_TABLES = [
    "dim_date", "dim_customers", "dim_products", "dim_stores", "dim_employees", "dim_suppliers", "dim_promotions",
    "dim_categories", "dim_addresses", "dim_campaigns",
    "fact_sales", "fact_returns", "fact_inventory_snapshots", "fact_web_sessions", "fact_payments",
    "fact_loyalty_transactions", "fact_order_items", "fact_shipments", "fact_reviews", "fact_promotions_usage",
    "fact_cart_abandonment", "fact_customer_interactions", "fact_supplier_orders", "fact_store_performance",
    "fact_employee_sales",
]

MARTS = {
    "daily_sales_summary": lambda w: marts.daily_sales(w.fact_sales, w.dim_date),
    "monthly_revenue": lambda w: marts.monthly_revenue(w.fact_sales, w.dim_date),
    "customer_lifetime_value": lambda w: marts.customer_ltv(w.orders, w.returns, w.dim_customers, w.as_of),
    "product_performance": lambda w: marts.product_performance(w.dim_products, w.fact_order_items, w.fact_reviews),
    "store_performance_monthly": lambda w: marts.store_monthly(w.fact_sales, w.dim_stores, w.dim_date),
    "category_revenue": lambda w: marts.category_revenue(w.fact_order_items, w.dim_products, w.dim_categories,
                                                         w.dim_date),
    "top_customers": lambda w: marts.top_customers(MARTS["customer_lifetime_value"](w), w.customer_segments, w.as_of),
    "top_products": lambda w: marts.top_products(MARTS["product_performance"](w)),
    "campaign_effectiveness": lambda w: marts.campaign_effectiveness(w.dim_campaigns, w.fact_web_sessions,
                                                                     w.fact_sales),
    "inventory_health": lambda w: marts.inventory_health(w.fact_inventory_snapshots, w.fact_order_items,
                                                         w.dim_products, w.as_of),
    "supplier_performance": lambda w: marts.supplier_performance(w.dim_suppliers, w.fact_supplier_orders,
                                                                 w.fact_order_items, w.fact_returns),
    "customer_cohort_analysis": lambda w: marts.cohorts(w.orders),
    "employee_performance": lambda w: marts.employee_monthly(w.fact_employee_sales, w.employee_links, w.orders,
                                                             w.dim_employees, w.dim_date),
    "seasonal_trends": lambda w: marts.seasonal(w.fact_sales, w.dim_date),
    "geographic_performance": lambda w: marts.geo_performance(w.fact_sales, w.dim_customers, w.dim_addresses,
                                                              w.dim_date),
    "channel_attribution": lambda w: marts.channel_attribution(w.fact_sales, w.dim_date),
    "promotion_roi": lambda w: marts.promotion_roi(w.dim_promotions, w.fact_promotions_usage),
    "customer_churn_indicators": lambda w: marts.churn_indicators(w.orders, w.web_sessions, w.dim_customers,
                                                                  w.as_of),
    "product_affinity": lambda w: marts.product_affinity(w.fact_order_items, w.dim_products, w.dim_customers,
                                                         w.as_of),
    "net_promoter_score": lambda w: marts.nps(w.fact_reviews, w.dim_products),
    "fulfillment_metrics": lambda w: marts.fulfillment(w.fact_shipments, w.dim_date),
    "loyalty_program_performance": lambda w: marts.loyalty_performance(w.fact_loyalty_transactions, w.dim_date),
}


def build(wh: Warehouse, name: str) -> DataFrame:
    if name.startswith("silver_"):
        t = name[len("silver_"):]
        return getattr(wh, t).select(*SILVER_COLUMNS[t].split())
    if name in MARTS:
        return MARTS[name](wh)
    return getattr(wh, name)


def names() -> list[str]:
    return [f"silver_{t}" for t in SILVER_COLUMNS] + GOLD_TABLES + list(MARTS)


def _grid(w: Warehouse):
    from strata.streaming import telemetry as T
    from strata.sources.feeds import table
    readings = T.readings_from_events(table(w.spark, w.sf_dir, "events"))
    return T.evaluate_readings(readings, T.node_dim(w.spark))


def _grid_status(w: Warehouse):
    from pyspark.sql import functions as F
    return _grid(w).select("node_id", "timestamp", "voltage_kv", "load_pct", "frequency_hz", "nominal_voltage_kv",
                           "nominal_frequency_hz", F.size("issues").cast("bigint").alias("issue_count"), "status")


def _grid_alerts(w: Warehouse):
    from pyspark.sql import functions as F
    from strata.streaming import telemetry as T
    a = T.alerts(_grid(w))
    has = lambda p: F.exists("issues", lambda i: i.startswith(p))
    return a.select("node_id", "timestamp", "severity", F.size("issues").cast("bigint").alias("issue_count"),
                    has("Voltage").alias("voltage_breach"), has("Load").alias("load_breach"),
                    has("Frequency").alias("frequency_breach"), "voltage_kv", "load_pct", "frequency_hz")


MARTS["basket_analysis"] = lambda w: basket.basket_pairs(w.fact_order_items, w.dim_products)
MARTS["basket_analysis_pairs"] = lambda w: basket.basket_pairs(w.fact_order_items, w.dim_products, min_count=2)
MARTS["payments_second_load"] = lambda w: w.payments_second_load.select(*SILVER_COLUMNS["payments"].split())
MARTS["inventory_second_load"] = lambda w: w.inventory_second_load.select(*SILVER_COLUMNS["inventory"].split())
MARTS["shipments_second_load"] = lambda w: w.shipments_second_load.select(*SILVER_COLUMNS["shipments"].split())
MARTS["customer_segments_two_days"] = lambda w: w.customer_segments_two_days.select(*SILVER_COLUMNS["customer_segments"].split())
MARTS["grid_reading_status"] = _grid_status
MARTS["grid_alerts"] = _grid_alerts


MARTS["return_rate_analysis"] = lambda w: marts.return_rates(w.fact_returns, w.fact_order_items, w.dim_products,
                                                             w.dim_date)
MARTS["executive_dashboard"] = lambda w: marts.executive_dashboard(
    w.fact_sales, w.orders, w.returns, w.fact_inventory_snapshots, w.loyalty_points,
    marts.nps(w.fact_reviews, w.dim_products), w.as_of)


def _grid_outages(w: Warehouse):
    from strata.streaming import telemetry as T
    return T.outages(_grid(w), T.node_dim(w.spark))


MARTS["grid_outages"] = _grid_outages


def _raw_envelope(w: Warehouse, name: str):
    """Raw landing rows without the payload: lifted keys, lineage, load stamp,
    batch id (and the payload's event type for cart events)."""
    from pyspark.sql import functions as F
    df = w.landed(name)
    keys = list(SOURCES[name].keys)
    return df.select(*keys, "file_name", "file_row_number", "load_timestamp", "batch_id")


for _feed in SOURCES:
    MARTS[f"raw_{_feed}"] = lambda w, name=_feed: _raw_envelope(w, name)


def _grid_alert_text(w: Warehouse):
    from strata.streaming import telemetry as T
    return T.alert_text(T.alerts(_grid(w))).select("node_id", "timestamp", "severity", "message")


MARTS["grid_alert_text"] = _grid_alert_text


def _landed_files(w: Warehouse, name: str, source: str, write, **options):
    """A feed's payloads as files of many lines in the shared folder, read back by the landing readers.  Files
    keep no order over tasks, so a row is given with its file's size and whether its number is the
    line's own."""
    import uuid

    from pyspark.sql import functions as F
    from strata.session import ensure_checkpoint_dir
    from strata.sources import raw
    folder = f"{ensure_checkpoint_dir(w.spark).rstrip('/')}/strata-landing/{uuid.uuid4().hex}"
    write(w.landed(name), folder)
    rows = raw.lift_keys(raw.split_bad(raw.READERS[SOURCES[source].fmt](w.spark, folder, **options))[0], SOURCES[source].keys)
    per_file = rows.groupBy("file_name").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("file_row_number").alias("d"), F.min("file_row_number").alias("a"), F.max("file_row_number").alias("z"))
    good = per_file.select("file_name", ((F.col("d") == F.col("n")) & (F.col("a") == 0) & (F.col("z") == F.col("n") - 1)).alias("numbers_whole"))
    return rows.join(good, "file_name").select(*SOURCES[source].keys, "numbers_whole")


MARTS["landing_json_orders"] = lambda w: _landed_files(w, "orders", "orders", lambda df, to: df.selectExpr("to_json(payload)").write.text(to))
MARTS["landing_csv_stores"] = lambda w: _landed_files(
    w, "stores", "stores", lambda df, to: df.selectExpr("variant_get(payload, '$.store_id', 'string') AS store_id", "variant_get(payload, '$.name', 'string') AS name").write.option("header", True).csv(to))
MARTS["landing_parquet_suppliers"] = lambda w: _landed_files(
    w, "suppliers", "suppliers", lambda df, to: df.selectExpr("variant_get(payload, '$.supplier_id', 'string') AS supplier_id", "variant_get(payload, '$.rating', 'double') AS rating").write.parquet(to))
