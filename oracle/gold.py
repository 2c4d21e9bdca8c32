"""DuckDB oracle SQL for gold dimensions, facts and marts (the published
definitions with the documented defect decisions applied)."""

from __future__ import annotations

from oracle.bind import AS_OF, cte

# ------------------------------------------------------------------ dims
cte("g_dim_date", """
SELECT CAST(year(d) * 10000 + month(d) * 100 + day(d) AS BIGINT) AS date_sk, d AS full_date,
       CAST(isodow(d) AS BIGINT) AS day_of_week, strftime(d, '%a') AS day_name, CAST(day(d) AS BIGINT) AS day_of_month,
       CAST(dayofyear(d) AS BIGINT) AS day_of_year, CAST(weekofyear(d) AS BIGINT) AS week_of_year,
       CAST(weekofyear(d) AS BIGINT) AS iso_week_number, CAST(month(d) AS BIGINT) AS month_number,
       strftime(d, '%b') AS month_name, left(strftime(d, '%b'), 3) AS month_name_short,
       CAST(quarter(d) AS BIGINT) AS quarter_number, 'Q' || CAST(quarter(d) AS VARCHAR) AS quarter_name,
       CAST(year(d) AS BIGINT) AS year_number,
       CAST(CASE WHEN month(d) >= 2 THEN year(d) ELSE year(d) - 1 END AS BIGINT) AS fiscal_year,
       CAST(CASE WHEN month(d) BETWEEN 2 AND 4 THEN 1 WHEN month(d) BETWEEN 5 AND 7 THEN 2
                 WHEN month(d) BETWEEN 8 AND 10 THEN 3 ELSE 4 END AS BIGINT) AS fiscal_quarter,
       CAST((month(d) - 2 + 12) % 12 + 1 AS BIGINT) AS fiscal_month,
       isodow(d) IN (6, 7) AS is_weekend, isodow(d) NOT IN (6, 7) AS is_weekday,
       CAST(date_trunc('week', d) AS DATE) AS week_start_date, CAST(date_trunc('week', d) AS DATE) + 6 AS week_end_date,
       CAST(date_trunc('month', d) AS DATE) AS month_start_date, last_day(d) AS month_end_date,
       CAST(date_trunc('quarter', d) AS DATE) AS quarter_start_date,
       CAST(date_trunc('quarter', d) + INTERVAL 3 MONTH AS DATE) - 1 AS quarter_end_date,
       CAST(date_trunc('year', d) AS DATE) AS year_start_date,
       CAST(date_trunc('year', d) + INTERVAL 1 YEAR AS DATE) - 1 AS year_end_date,
       CAST(day(last_day(d)) AS BIGINT) AS days_in_month, d = last_day(d) AS is_last_day_of_month,
       CASE WHEN month(d) = 1 AND day(d) = 1 THEN 'New Year''s Day' WHEN month(d) = 7 AND day(d) = 4 THEN 'Independence Day'
            WHEN month(d) = 12 AND day(d) = 25 THEN 'Christmas Day' END AS holiday_name,
       (month(d) = 1 AND day(d) = 1) OR (month(d) = 7 AND day(d) = 4) OR (month(d) = 12 AND day(d) = 25) AS is_holiday
FROM (SELECT CAST(unnest(generate_series(CAST(date_trunc('year', LEAST((SELECT MIN(order_date) FROM s_orders), (SELECT MIN(ship_date) FROM s_shipments))) AS DATE),
                                          DATE '2035-12-31', INTERVAL 1 DAY)) AS DATE) AS d)""")

cte("g_dim_customers", f"""
SELECT customer_sk, customer_id, first_name, last_name, full_name, email, phone, date_of_birth, gender,
       customer_tier, registration_date, is_active, effective_from, effective_to, is_current,
       CAST(year({AS_OF}) - year(date_of_birth) AS BIGINT) AS age_years,
       CASE WHEN date_of_birth IS NULL THEN 'UNKNOWN'
            WHEN year({AS_OF}) - year(date_of_birth) < 25 THEN '18-24'
            WHEN year({AS_OF}) - year(date_of_birth) < 35 THEN '25-34'
            WHEN year({AS_OF}) - year(date_of_birth) < 45 THEN '35-44'
            WHEN year({AS_OF}) - year(date_of_birth) < 55 THEN '45-54' ELSE '55+' END AS age_band,
       CAST(datediff('day', registration_date, {AS_OF}) AS BIGINT) AS days_as_customer,
       CASE WHEN datediff('day', registration_date, {AS_OF}) <= 30 THEN 'NEW'
            WHEN datediff('day', registration_date, {AS_OF}) <= 180 THEN 'DEVELOPING'
            WHEN datediff('day', registration_date, {AS_OF}) <= 365 THEN 'ESTABLISHED' ELSE 'VETERAN' END AS tenure_band,
       CAST(year(registration_date) AS BIGINT) AS registration_year
FROM s_customers""")

cte("g_dim_products", """
SELECT product_sk, product_id, sku, product_name, brand, category_id, category_name, parent_category_name,
       top_category_name, category_path, supplier_id, supplier_name, unit_cost, unit_price, margin_pct, is_active,
       is_digital, weight_kg,
       CASE WHEN unit_price < 10 THEN 'UNDER_$10' WHEN unit_price < 25 THEN '$10-$25' WHEN unit_price < 50 THEN '$25-$50'
            WHEN unit_price < 100 THEN '$50-$100' WHEN unit_price < 250 THEN '$100-$250'
            WHEN unit_price < 500 THEN '$250-$500' ELSE 'OVER_$500' END AS price_band,
       CASE WHEN margin_pct >= 60 THEN 'HIGH' WHEN margin_pct >= 30 THEN 'MEDIUM' ELSE 'LOW' END AS margin_band
FROM s_product_catalog""")

cte("g_dim_stores", f"""
SELECT *, CAST(year({AS_OF}) - year(opening_date) AS BIGINT) AS years_open,
       CASE WHEN square_footage >= 10000 THEN 'LARGE' WHEN square_footage >= 3000 THEN 'MEDIUM' ELSE 'SMALL' END AS size_category
FROM s_stores""")

cte("g_dim_employees", f"""
SELECT *, CAST(year(COALESCE(termination_date, {AS_OF})) - year(hire_date) AS BIGINT) AS tenure_years
FROM s_employees""")

cte("g_dim_suppliers", """
SELECT *, CASE WHEN supplier_rating >= 4.5 THEN 'PREFERRED' WHEN supplier_rating >= 3.5 THEN 'APPROVED'
               WHEN supplier_rating >= 2.5 THEN 'CONDITIONAL' ELSE 'PROBATION' END AS supplier_status_label
FROM s_suppliers""")

cte("g_dim_promotions", """
SELECT *, CAST(datediff('day', start_date, end_date) AS BIGINT) AS duration_days,
       CASE WHEN usage_limit > 0 THEN CAST(times_used AS DOUBLE) / CAST(usage_limit AS DOUBLE) * 100 END AS usage_rate_pct
FROM s_promotions""")

cte("g_dim_categories", """
SELECT c.category_sk, c.category_id, c.category_name, c.parent_category_id, p.category_name AS parent_category_name,
       c.category_level, c.category_path, c.is_active
FROM s_categories c LEFT JOIN s_categories p ON c.parent_category_id = p.category_id""")

cte("g_dim_addresses", """
SELECT address_sk, address_id, customer_id, address_type, address_line1, address_line2, city, state_province,
       postal_code, country_code, is_default, is_validated, latitude, longitude, is_current
FROM s_addresses WHERE is_current""")

cte("g_dim_campaigns", """
SELECT *, CAST(datediff('day', start_date, end_date) AS BIGINT) AS campaign_duration_days,
       CASE WHEN impressions > 0 THEN CAST(clicks AS DOUBLE) / CAST(impressions AS DOUBLE) * 100 END AS ctr_pct,
       CASE WHEN clicks > 0 THEN CAST(conversions AS DOUBLE) / CAST(clicks AS DOUBLE) * 100 END AS conversion_rate_pct,
       CASE WHEN conversions > 0 THEN CAST(spend_amount AS DOUBLE) / CAST(conversions AS DOUBLE) END AS cost_per_conversion,
       CASE WHEN spend_amount > 0 THEN (CAST(revenue_attributed AS DOUBLE) - CAST(spend_amount AS DOUBLE))
            / CAST(spend_amount AS DOUBLE) * 100 END AS roas_pct
FROM s_campaigns""")

cte("cur_cust", "SELECT customer_id AS c_id, customer_sk FROM g_dim_customers WHERE is_current")

# ------------------------------------------------------------------ facts
DK = "CAST(year({0}) * 10000 + month({0}) * 100 + day({0}) AS BIGINT)"

cte("g_fact_sales", f"""
SELECT o.order_sk, {DK.format('o.order_date')} AS date_sk, c.customer_sk, s.store_sk, p.promotion_sk,
       o.order_id, o.customer_id, o.store_id, o.promotion_id, o.channel, o.order_status, o.currency_code,
       o.subtotal_amount, o.discount_amount, o.tax_amount, o.shipping_amount, o.total_amount,
       o.total_amount - o.discount_amount AS net_revenue, o.is_first_order, o.order_date, o.order_timestamp
FROM s_orders o LEFT JOIN cur_cust c ON o.customer_id = c.c_id
LEFT JOIN g_dim_stores s ON o.store_id = s.store_id
LEFT JOIN g_dim_promotions p ON o.promotion_id = p.promotion_id""")

cte("g_fact_returns", f"""
SELECT r.return_sk, {DK.format('r.return_date')} AS date_sk, c.customer_sk, o.order_sk, r.return_id, r.order_id,
       r.customer_id, r.return_date, r.return_reason, r.return_status, r.refund_amount, r.refund_method,
       r.items_count, CAST(datediff('day', o.order_date, r.return_date) AS BIGINT) AS days_to_return
FROM s_returns r LEFT JOIN s_orders o ON r.order_id = o.order_id LEFT JOIN cur_cust c ON r.customer_id = c.c_id""")

cte("g_fact_inventory_snapshots", f"""
SELECT i.inventory_sk, {DK.format('i.snapshot_date')} AS date_sk, p.product_sk, s.supplier_sk, i.product_id,
       i.location_id, i.location_type, i.quantity_on_hand, i.quantity_reserved, i.quantity_available,
       i.reorder_point, i.reorder_quantity, i.snapshot_date, i.snapshot_timestamp,
       COALESCE(i.quantity_available <= i.reorder_point, FALSE) AS is_below_reorder,
       COALESCE(i.quantity_available = 0, FALSE) AS is_out_of_stock,
       CAST(p.unit_cost * i.quantity_on_hand AS DECIMAL(18,4)) AS inventory_value
FROM s_inventory i LEFT JOIN g_dim_products p ON i.product_id = p.product_id
LEFT JOIN g_dim_suppliers s ON p.supplier_id = s.supplier_id""")

cte("g_fact_web_sessions", f"""
SELECT ws.session_sk, {DK.format('CAST(ws.session_start AS DATE)')} AS date_sk, c.customer_sk, cam.campaign_sk,
       ws.session_id, ws.customer_id, ws.device_type, ws.browser, ws.os, ws.channel, ws.campaign_id,
       ws.session_start, ws.session_end, ws.session_duration_sec, ws.page_views, ws.is_bounce, ws.converted,
       ws.order_id, ws.landing_page
FROM s_web_sessions ws LEFT JOIN cur_cust c ON ws.customer_id = c.c_id
LEFT JOIN g_dim_campaigns cam ON ws.campaign_id = cam.campaign_id""")

cte("g_fact_payments", f"""
SELECT p.payment_sk, {DK.format('CAST(p.payment_timestamp AS DATE)')} AS date_sk, c.customer_sk, o.order_sk,
       p.payment_id, p.order_id, p.customer_id, p.payment_method, p.payment_status, p.amount, p.currency_code,
       p.payment_timestamp, p.is_refund, p.original_payment_id
FROM s_payments p LEFT JOIN s_orders o ON p.order_id = o.order_id LEFT JOIN cur_cust c ON p.customer_id = c.c_id""")

cte("g_fact_loyalty_transactions", f"""
SELECT lp.loyalty_sk, {DK.format('lp.transaction_date')} AS date_sk, c.customer_sk, o.order_sk, lp.transaction_id,
       lp.customer_id, lp.order_id, lp.transaction_type, lp.points_change, lp.points_balance_after,
       lp.transaction_date, lp.transaction_timestamp, lp.expiry_date, lp.reference_code
FROM s_loyalty_points lp LEFT JOIN s_orders o ON lp.order_id = o.order_id LEFT JOIN cur_cust c ON lp.customer_id = c.c_id""")

cte("g_fact_order_items", f"""
SELECT oi.order_item_sk, {DK.format('o.order_date')} AS date_sk, c.customer_sk, p.product_sk, s.store_sk,
       pr.promotion_sk, oi.order_id, oi.item_id, oi.product_id, o.customer_id, o.store_id, o.channel, o.order_date,
       oi.quantity, oi.unit_price, oi.discount_amount, oi.tax_amount, oi.line_total, p.unit_cost,
       CAST(oi.quantity * p.unit_cost AS DECIMAL(18,4)) AS cogs,
       CAST(oi.line_total - CAST(oi.quantity * p.unit_cost AS DECIMAL(18,4)) AS DECIMAL(18,4)) AS gross_profit,
       CASE WHEN oi.line_total <> 0 THEN CAST(CAST(oi.line_total - CAST(oi.quantity * p.unit_cost AS DECIMAL(18,4)) AS DECIMAL(18,4)) AS DOUBLE)
            / CAST(oi.line_total AS DOUBLE) * 100 END AS margin_pct,
       oi.return_flag
FROM s_order_items oi JOIN s_orders o ON oi.order_id = o.order_id
LEFT JOIN cur_cust c ON o.customer_id = c.c_id
LEFT JOIN g_dim_products p ON oi.product_id = p.product_id
LEFT JOIN g_dim_stores s ON o.store_id = s.store_id
LEFT JOIN g_dim_promotions pr ON o.promotion_id = pr.promotion_id""")

cte("g_fact_shipments", f"""
SELECT sh.shipment_sk, {DK.format('sh.ship_date')} AS ship_date_sk, {DK.format('sh.actual_delivery')} AS delivery_date_sk,
       c.customer_sk, o.order_sk, sh.shipment_id, sh.order_id, sh.customer_id, sh.carrier, sh.tracking_number,
       sh.ship_date, sh.estimated_delivery, sh.actual_delivery, sh.shipment_status, sh.shipping_method,
       sh.destination_country, sh.weight_kg, sh.shipping_cost, sh.is_late, sh.days_to_deliver,
       CAST(CASE WHEN sh.actual_delivery IS NOT NULL THEN datediff('day', sh.estimated_delivery, sh.actual_delivery) END AS BIGINT) AS days_late
FROM s_shipments sh LEFT JOIN s_orders o ON sh.order_id = o.order_id LEFT JOIN cur_cust c ON sh.customer_id = c.c_id""")

cte("g_fact_reviews", f"""
SELECT r.review_sk, {DK.format('r.review_date')} AS date_sk, c.customer_sk, p.product_sk, o.order_sk, r.review_id,
       r.product_id, r.customer_id, r.order_id, r.rating, r.review_date, r.is_verified_purchase, r.is_flagged,
       r.helpful_votes, COALESCE(r.rating >= 4, FALSE) AS is_positive, COALESCE(r.rating <= 2, FALSE) AS is_negative
FROM s_reviews r LEFT JOIN cur_cust c ON r.customer_id = c.c_id
LEFT JOIN g_dim_products p ON r.product_id = p.product_id LEFT JOIN s_orders o ON r.order_id = o.order_id""")

cte("g_fact_promotions_usage", f"""
SELECT o.order_sk, {DK.format('o.order_date')} AS date_sk, c.customer_sk, pr.promotion_sk, o.order_id, o.customer_id,
       o.promotion_id, pr.promotion_type, pr.discount_value, o.discount_amount AS actual_discount_given,
       o.subtotal_amount, o.total_amount,
       CASE WHEN o.subtotal_amount > 0 THEN CAST(o.discount_amount AS DOUBLE) / CAST(o.subtotal_amount AS DOUBLE) * 100 END AS effective_discount_pct,
       o.order_date, o.is_first_order
FROM s_orders o JOIN g_dim_promotions pr ON o.promotion_id = pr.promotion_id
LEFT JOIN cur_cust c ON o.customer_id = c.c_id WHERE o.promotion_id IS NOT NULL""")

cte("g_fact_cart_abandonment", f"""
SELECT ws.session_sk, {DK.format('CAST(ws.session_start AS DATE)')} AS date_sk, c.customer_sk, ws.session_id,
       ws.customer_id, ws.device_type, ws.channel, ws.session_start, cs.first_cart_event, cs.last_cart_event,
       cs.items_added, cs.items_removed, cs.items_added - cs.items_removed AS net_items_in_cart,
       CAST(epoch(date_trunc('second', cs.last_cart_event)) - epoch(date_trunc('second', cs.first_cart_event)) AS BIGINT) AS time_in_cart_sec
FROM (SELECT src_session_id AS session_id, MIN(load_timestamp) AS first_cart_event, MAX(load_timestamp) AS last_cart_event,
             COUNT(*) AS cart_event_count,
             CAST(SUM(CASE WHEN event_type = 'add_to_cart' THEN 1 ELSE 0 END) AS BIGINT) AS items_added,
             CAST(SUM(CASE WHEN event_type = 'remove_from_cart' THEN 1 ELSE 0 END) AS BIGINT) AS items_removed
      FROM raw_cart_events WHERE event_type IN ('add_to_cart', 'remove_from_cart', 'checkout_started')
      GROUP BY src_session_id) cs
JOIN s_web_sessions ws ON cs.session_id = ws.session_id
LEFT JOIN cur_cust c ON ws.customer_id = c.c_id
WHERE ws.converted = FALSE""")

cte("g_fact_customer_interactions", f"""
SELECT c.customer_sk, {DK.format('o.order_date')} AS date_sk, o.order_id AS interaction_id, o.customer_id,
       'ORDER' AS interaction_type, o.order_date AS interaction_date, CAST(o.total_amount AS DECIMAL(18,2)) AS interaction_value,
       o.channel
FROM s_orders o LEFT JOIN cur_cust c ON o.customer_id = c.c_id
UNION ALL
SELECT c.customer_sk, {DK.format('r.return_date')}, r.return_id, r.customer_id, 'RETURN', r.return_date,
       CAST(-r.refund_amount AS DECIMAL(18,2)), NULL
FROM s_returns r LEFT JOIN cur_cust c ON r.customer_id = c.c_id
UNION ALL
SELECT c.customer_sk, {DK.format('v.review_date')}, v.review_id, v.customer_id, 'REVIEW', v.review_date,
       CAST(NULL AS DECIMAL(18,2)), NULL
FROM s_reviews v LEFT JOIN cur_cust c ON v.customer_id = c.c_id""")

cte("g_fact_supplier_orders", f"""
SELECT ROW_NUMBER() OVER (ORDER BY po.order_date NULLS LAST, po.po_number NULLS LAST) AS supplier_order_sk,
       {DK.format('po.order_date')} AS date_sk, s.supplier_sk, p.product_sk, po.po_number, po.supplier_id, po.product_id,
       po.order_date, po.expected_delivery, po.actual_delivery, po.quantity_ordered, po.quantity_received,
       po.unit_cost, po.total_cost, po.po_status,
       COALESCE(po.actual_delivery > po.expected_delivery, FALSE) AS is_late_delivery,
       CAST(datediff('day', po.expected_delivery, po.actual_delivery) AS BIGINT) AS delivery_variance_days,
       po.quantity_received - po.quantity_ordered AS quantity_variance
FROM s_purchase_orders po LEFT JOIN g_dim_suppliers s ON po.supplier_id = s.supplier_id
LEFT JOIN g_dim_products p ON po.product_id = p.product_id""")

cte("g_fact_store_performance", f"""
SELECT s.store_sk, {DK.format('g.order_date')} AS date_sk, g.store_id, g.order_date, g.orders_count, g.unique_customers,
       CAST(g.rev AS DOUBLE) AS total_revenue, CAST(g.gross AS DOUBLE) AS gross_revenue,
       CAST(g.disc AS DOUBLE) AS total_discounts, CAST(g.tax AS DOUBLE) AS total_tax,
       CAST(g.rev AS DOUBLE) / g.n AS avg_order_value, g.new_customers, CAST(g.ret AS DOUBLE) AS returned_revenue
FROM (SELECT store_id, order_date, COUNT(DISTINCT order_id) AS orders_count, COUNT(DISTINCT customer_id) AS unique_customers,
             SUM(total_amount) AS rev, SUM(subtotal_amount) AS gross, SUM(discount_amount) AS disc, SUM(tax_amount) AS tax,
             COUNT(total_amount) AS n,
             COUNT(DISTINCT CASE WHEN is_first_order THEN customer_id END) AS new_customers,
             SUM(CASE WHEN order_status = 'RETURNED' THEN total_amount ELSE 0 END) AS ret
      FROM s_orders WHERE order_status <> 'CANCELLED' GROUP BY store_id, order_date) g
LEFT JOIN g_dim_stores s ON g.store_id = s.store_id""")

cte("g_fact_employee_sales", f"""
SELECT e.employee_sk, {DK.format('g.order_date')} AS date_sk, s.store_sk, g.employee_id, g.store_id, g.order_date,
       g.orders_taken, g.customers_served, CAST(g.sales AS DOUBLE) AS total_sales_amount,
       CAST(g.sales AS DOUBLE) / g.n AS avg_transaction_value, CAST(g.disc AS DOUBLE) AS total_discounts_given
FROM (SELECT l.employee_id, o.store_id, o.order_date, COUNT(DISTINCT o.order_id) AS orders_taken,
             COUNT(DISTINCT o.customer_id) AS customers_served, SUM(o.total_amount) AS sales,
             COUNT(o.total_amount) AS n, SUM(o.discount_amount) AS disc
      FROM s_employee_links l JOIN s_orders o ON l.order_id = o.order_id
      GROUP BY l.employee_id, o.store_id, o.order_date) g
LEFT JOIN (SELECT * FROM g_dim_employees WHERE is_current) e ON g.employee_id = e.employee_id
LEFT JOIN g_dim_stores s ON g.store_id = s.store_id""")
