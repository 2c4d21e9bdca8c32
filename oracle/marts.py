"""DuckDB oracle SQL for the marts."""

from __future__ import annotations

from oracle.bind import AS_OF, cte

cte("m_daily_sales_summary", """
SELECT sale_date, year_number, quarter_name, month_name, week_of_year, is_weekend, is_holiday, total_orders,
       unique_customers, new_customers, CAST(rev AS DOUBLE) AS gross_revenue, CAST(disc AS DOUBLE) AS total_discounts,
       CAST(tax AS DOUBLE) AS total_tax, CAST(ship AS DOUBLE) AS total_shipping, CAST(net AS DOUBLE) AS net_revenue,
       CAST(rev AS DOUBLE) / n AS avg_order_value,
       CASE WHEN unique_customers > 0 THEN CAST(rev AS DOUBLE) / unique_customers END AS revenue_per_customer,
       promo_orders, CAST(pdisc AS DOUBLE) AS promo_discount_amount,
       CAST(LAG(rev) OVER w AS DOUBLE) AS prev_day_revenue,
       CAST(rev - LAG(rev) OVER w AS DOUBLE) AS revenue_dod_change,
       CAST(SUM(rev) OVER (w ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS DOUBLE)
         / COUNT(rev) OVER (w ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS revenue_7d_rolling_avg,
       CAST(SUM(rev) OVER (w ROWS BETWEEN 27 PRECEDING AND CURRENT ROW) AS DOUBLE)
         / COUNT(rev) OVER (w ROWS BETWEEN 27 PRECEDING AND CURRENT ROW) AS revenue_28d_rolling_avg
FROM (SELECT d.full_date AS sale_date, d.year_number, d.quarter_name, d.month_name, d.week_of_year, d.is_weekend,
             d.is_holiday, COUNT(DISTINCT fs.order_id) AS total_orders, COUNT(DISTINCT fs.customer_id) AS unique_customers,
             COUNT(DISTINCT CASE WHEN fs.is_first_order THEN fs.customer_id END) AS new_customers,
             SUM(fs.total_amount) AS rev, SUM(fs.discount_amount) AS disc, SUM(fs.tax_amount) AS tax,
             SUM(fs.shipping_amount) AS ship, SUM(fs.net_revenue) AS net, COUNT(fs.total_amount) AS n,
             COUNT(DISTINCT CASE WHEN fs.promotion_id IS NOT NULL THEN fs.order_id END) AS promo_orders,
             SUM(CASE WHEN fs.promotion_id IS NOT NULL THEN fs.discount_amount ELSE 0 END) AS pdisc
      FROM g_fact_sales fs JOIN g_dim_date d ON fs.date_sk = d.date_sk
      GROUP BY d.full_date, d.year_number, d.quarter_name, d.month_name, d.week_of_year, d.is_weekend, d.is_holiday) g
WINDOW w AS (ORDER BY sale_date)""")

cte("m_monthly_base", """
SELECT d.year_number, d.month_number, d.month_name, d.month_start_date, d.month_end_date, d.fiscal_year, d.fiscal_month,
       COUNT(DISTINCT fs.order_id) AS orders, COUNT(DISTINCT fs.customer_id) AS customers, SUM(fs.total_amount) AS rev,
       SUM(fs.net_revenue) AS net, SUM(fs.discount_amount) AS disc, SUM(fs.tax_amount) AS tax,
       SUM(fs.shipping_amount) AS ship, COUNT(fs.total_amount) AS n, COUNT(DISTINCT fs.store_id) AS active_stores
FROM g_fact_sales fs JOIN g_dim_date d ON fs.date_sk = d.date_sk
GROUP BY d.year_number, d.month_number, d.month_name, d.month_start_date, d.month_end_date, d.fiscal_year, d.fiscal_month""")

cte("m_monthly_revenue", """
SELECT m.year_number, m.month_number, m.month_name, m.month_start_date, m.month_end_date, m.fiscal_year, m.fiscal_month,
       m.orders, m.customers, CAST(m.rev AS DOUBLE) AS gross_revenue, CAST(m.net AS DOUBLE) AS net_revenue,
       CAST(m.disc AS DOUBLE) AS discounts, CAST(m.tax AS DOUBLE) AS tax, CAST(m.ship AS DOUBLE) AS shipping_revenue,
       CAST(m.rev AS DOUBLE) / m.n AS aov, m.active_stores,
       CAST(LAG(m.rev) OVER w AS DOUBLE) AS prev_month_revenue,
       CAST(m.rev - LAG(m.rev) OVER w AS DOUBLE) AS revenue_mom_change,
       CASE WHEN CAST(LAG(m.rev) OVER w AS DOUBLE) > 0 THEN (CAST(m.rev AS DOUBLE) - CAST(LAG(m.rev) OVER w AS DOUBLE))
            / CAST(LAG(m.rev) OVER w AS DOUBLE) * 100 END AS revenue_mom_pct,
       CAST(ly.rev AS DOUBLE) AS same_month_ly_revenue,
       CASE WHEN CAST(ly.rev AS DOUBLE) > 0 THEN (CAST(m.rev AS DOUBLE) - CAST(ly.rev AS DOUBLE)) / CAST(ly.rev AS DOUBLE) * 100
            END AS revenue_yoy_pct,
       CAST(SUM(m.rev) OVER (PARTITION BY m.year_number ORDER BY m.month_number) AS DOUBLE) AS ytd_revenue
FROM m_monthly_base m LEFT JOIN m_monthly_base ly ON ly.year_number + 1 = m.year_number AND ly.month_number = m.month_number
WINDOW w AS (ORDER BY m.year_number, m.month_number)""")

cte("m_customer_lifetime_value", f"""
SELECT c.customer_sk, os.customer_id, c.full_name, c.customer_tier, c.registration_date, os.first_order_date,
       os.last_order_date, os.total_orders, CAST(os.rev AS DOUBLE) AS lifetime_revenue,
       CAST(os.rev AS DOUBLE) / os.n AS avg_order_value,
       CAST(datediff('day', os.first_order_date, os.last_order_date) AS BIGINT) AS customer_lifespan_days,
       CAST(datediff('day', os.last_order_date, {AS_OF}) AS BIGINT) AS days_since_last_order,
       os.order_value_stddev,
       CAST(COALESCE(rs.ret, 0) AS BIGINT) AS total_returns, CAST(COALESCE(rs.refund, 0) AS DOUBLE) AS total_refunds,
       CAST(os.rev - COALESCE(rs.refund, 0) AS DOUBLE) AS net_lifetime_revenue,
       CASE WHEN datediff('day', os.first_order_date, os.last_order_date) > 0
            THEN CAST(os.total_orders AS DOUBLE) / (CAST(datediff('day', os.first_order_date, os.last_order_date) AS DOUBLE) / 365.0)
            ELSE CAST(os.total_orders AS DOUBLE) END AS orders_per_year,
       CAST(os.rev AS DOUBLE) / os.n *
       CASE WHEN datediff('day', os.first_order_date, os.last_order_date) > 0
            THEN CAST(os.total_orders AS DOUBLE) / (CAST(datediff('day', os.first_order_date, os.last_order_date) AS DOUBLE) / 365.0)
            ELSE CAST(os.total_orders AS DOUBLE) END * 3 AS projected_clv_3yr,
       CASE WHEN datediff('day', os.last_order_date, {AS_OF}) <= 30 THEN 'LOW'
            WHEN datediff('day', os.last_order_date, {AS_OF}) <= 90 THEN 'MEDIUM'
            WHEN datediff('day', os.last_order_date, {AS_OF}) <= 180 THEN 'HIGH' ELSE 'CHURNED' END AS churn_risk,
       CASE WHEN os.rev >= 10000 THEN 'PLATINUM' WHEN os.rev >= 2500 THEN 'GOLD' WHEN os.rev >= 500 THEN 'SILVER'
            ELSE 'BRONZE' END AS clv_tier
FROM (SELECT customer_id, MIN(order_date) AS first_order_date, MAX(order_date) AS last_order_date,
             COUNT(DISTINCT order_id) AS total_orders, SUM(total_amount) AS rev, COUNT(total_amount) AS n,
             round(stddev_samp(CAST(total_amount AS DOUBLE)), 6) AS order_value_stddev
      FROM s_orders WHERE order_status NOT IN ('CANCELLED', 'RETURNED') GROUP BY customer_id) os
LEFT JOIN (SELECT o.customer_id, COUNT(DISTINCT r.return_id) AS ret, SUM(r.refund_amount) AS refund
           FROM s_returns r JOIN s_orders o ON r.order_id = o.order_id GROUP BY o.customer_id) rs
       ON os.customer_id = rs.customer_id
LEFT JOIN cur_cust_full c ON os.customer_id = c.customer_id""")

cte("cur_cust_full", "SELECT * FROM g_dim_customers WHERE is_current")

cte("m_product_performance_base", """
SELECT p.product_id, p.product_name, p.brand, p.category_name, p.top_category_name, p.unit_price, p.unit_cost,
       p.margin_pct AS list_margin_pct, i.units AS total_units_sold, COALESCE(i.orders_with_product, 0) AS orders_with_product,
       CAST(i.gross AS DOUBLE) AS gross_revenue, CAST(i.disc AS DOUBLE) AS total_discounts, CAST(i.net AS DOUBLE) AS net_revenue,
       CAST(i.sp AS DOUBLE) / i.spn AS avg_selling_price, CAST(i.gp AS DOUBLE) AS total_gross_profit,
       i.avg_realized_margin_pct, CAST(COALESCE(r.rc, 0) AS BIGINT) AS review_count,
       CAST(r.rs AS DOUBLE) / r.rn AS avg_rating, CAST(COALESCE(r.pos, 0) AS BIGINT) AS positive_reviews,
       CAST(COALESCE(r.neg, 0) AS BIGINT) AS negative_reviews, i.ret_units AS units_returned,
       CASE WHEN i.units > 0 THEN CAST(i.ret_units AS DOUBLE) / CAST(i.units AS DOUBLE) * 100 END AS return_rate_pct
FROM g_dim_products p
LEFT JOIN (SELECT product_id, CAST(SUM(quantity) AS BIGINT) AS units, COUNT(DISTINCT order_id) AS orders_with_product,
                  SUM(line_total) AS gross, SUM(discount_amount) AS disc, SUM(line_total - discount_amount) AS net,
                  SUM(unit_price) AS sp, COUNT(unit_price) AS spn, SUM(gross_profit) AS gp,
                  round(AVG(margin_pct), 6) AS avg_realized_margin_pct,
                  CAST(SUM(CASE WHEN return_flag THEN quantity ELSE 0 END) AS BIGINT) AS ret_units
           FROM g_fact_order_items GROUP BY product_id) i ON p.product_id = i.product_id
LEFT JOIN (SELECT product_id, COUNT(review_id) AS rc, SUM(rating) AS rs, COUNT(rating) AS rn,
                  SUM(CASE WHEN is_positive THEN 1 ELSE 0 END) AS pos, SUM(CASE WHEN is_negative THEN 1 ELSE 0 END) AS neg
           FROM g_fact_reviews GROUP BY product_id) r ON p.product_id = r.product_id""")

cte("m_product_performance", """
SELECT *, RANK() OVER (ORDER BY gross_revenue DESC NULLS LAST) AS revenue_rank,
       RANK() OVER (ORDER BY total_units_sold DESC NULLS LAST) AS units_rank
FROM m_product_performance_base""")

cte("m_store_base", """
SELECT s.store_id, s.store_name, s.store_type, s.city, s.state_province, s.country_code, s.square_footage,
       d.year_number, d.month_number, d.month_name, d.month_start_date,
       COUNT(DISTINCT fs.order_id) AS orders, COUNT(DISTINCT fs.customer_id) AS unique_customers,
       SUM(fs.total_amount) AS rev, SUM(fs.net_revenue) AS net, SUM(fs.discount_amount) AS disc, COUNT(fs.total_amount) AS n,
       COUNT(DISTINCT CASE WHEN fs.is_first_order THEN fs.customer_id END) AS new_customers
FROM g_fact_sales fs JOIN g_dim_stores s ON fs.store_sk = s.store_sk JOIN g_dim_date d ON fs.date_sk = d.date_sk
GROUP BY s.store_id, s.store_name, s.store_type, s.city, s.state_province, s.country_code, s.square_footage,
         d.year_number, d.month_number, d.month_name, d.month_start_date""")

cte("m_store_performance_monthly", """
SELECT m.store_id, m.store_name, m.store_type, m.city, m.state_province, m.country_code, m.square_footage,
       m.year_number, m.month_number, m.month_name, m.month_start_date, m.orders, m.unique_customers,
       CAST(m.rev AS DOUBLE) AS gross_revenue, CAST(m.net AS DOUBLE) AS net_revenue, CAST(m.disc AS DOUBLE) AS discounts,
       CAST(m.rev AS DOUBLE) / m.n AS aov, m.new_customers,
       CASE WHEN m.square_footage <> 0 THEN CAST(m.rev AS DOUBLE) / CAST(m.square_footage AS DOUBLE) END AS revenue_per_sqft,
       CAST(LAG(m.rev) OVER w AS DOUBLE) AS prev_month_revenue,
       CASE WHEN CAST(LAG(m.rev) OVER w AS DOUBLE) > 0 THEN (CAST(m.rev AS DOUBLE) - CAST(LAG(m.rev) OVER w AS DOUBLE))
            / CAST(LAG(m.rev) OVER w AS DOUBLE) * 100 END AS mom_growth_pct,
       CAST(ly.rev AS DOUBLE) AS same_month_ly,
       CASE WHEN CAST(ly.rev AS DOUBLE) > 0 THEN (CAST(m.rev AS DOUBLE) - CAST(ly.rev AS DOUBLE)) / CAST(ly.rev AS DOUBLE) * 100
            END AS yoy_growth_pct,
       RANK() OVER (PARTITION BY m.year_number, m.month_number ORDER BY m.rev DESC NULLS LAST) AS revenue_rank_in_period
FROM m_store_base m LEFT JOIN m_store_base ly
  ON ly.store_id = m.store_id AND ly.year_number + 1 = m.year_number AND ly.month_number = m.month_number
WINDOW w AS (PARTITION BY m.store_id ORDER BY m.year_number, m.month_number)""")

cte("m_category_revenue", """
SELECT *, CASE WHEN SUM(gross) OVER (PARTITION BY year_number, month_number) <> 0
               THEN CAST(gross AS DOUBLE) / CAST(SUM(gross) OVER (PARTITION BY year_number, month_number) AS DOUBLE) * 100
          END AS category_revenue_share_pct
FROM (SELECT cat.category_id, cat.category_name, cat.parent_category_name,
             split_part(cat.category_path, ' > ', 1) AS top_category_name, cat.category_path,
             d.year_number, d.quarter_name, d.month_number, d.month_name,
             COUNT(DISTINCT foi.order_id) AS orders, CAST(SUM(foi.quantity) AS BIGINT) AS units_sold, SUM(foi.line_total) AS gross,
             CAST(SUM(foi.discount_amount) AS DOUBLE) AS discounts,
             CAST(SUM(foi.line_total - foi.discount_amount) AS DOUBLE) AS net_revenue,
             CAST(SUM(foi.gross_profit) AS DOUBLE) AS gross_profit, round(AVG(foi.margin_pct), 6) AS avg_margin_pct,
             COUNT(DISTINCT foi.product_id) AS distinct_products_sold
      FROM g_fact_order_items foi JOIN g_dim_products p ON foi.product_id = p.product_id
      JOIN g_dim_categories cat ON p.category_id = cat.category_id
      JOIN g_dim_date d ON foi.date_sk = d.date_sk
      GROUP BY cat.category_id, cat.category_name, cat.parent_category_name, split_part(cat.category_path, ' > ', 1),
               cat.category_path, d.year_number, d.quarter_name, d.month_number, d.month_name)""")

cte("m_top_customers", f"""
SELECT clv.customer_sk, clv.customer_id, clv.full_name, clv.customer_tier, clv.clv_tier, clv.churn_risk,
       clv.first_order_date, clv.last_order_date, clv.total_orders, clv.lifetime_revenue, clv.net_lifetime_revenue,
       clv.avg_order_value, clv.orders_per_year, clv.projected_clv_3yr, clv.total_returns, clv.total_refunds,
       clv.days_since_last_order, seg.lifecycle_segment, seg.rfm_combined_score, seg.is_vip,
       RANK() OVER (ORDER BY clv.lifetime_revenue DESC NULLS LAST) AS revenue_rank,
       RANK() OVER (ORDER BY clv.total_orders DESC NULLS LAST) AS order_frequency_rank,
       RANK() OVER (ORDER BY clv.projected_clv_3yr DESC NULLS LAST) AS clv_rank,
       NTILE(10) OVER (ORDER BY clv.lifetime_revenue DESC NULLS LAST, clv.customer_id) AS revenue_decile
FROM m_customer_lifetime_value clv
LEFT JOIN s_customer_segments seg ON clv.customer_id = seg.customer_id AND seg.segment_date = {AS_OF}""")

cte("m_top_products", """
SELECT product_id, product_name, brand, category_name, top_category_name, unit_price, list_margin_pct,
       total_units_sold, orders_with_product, gross_revenue, net_revenue, total_gross_profit, avg_realized_margin_pct,
       review_count, avg_rating, return_rate_pct, revenue_rank, units_rank,
       RANK() OVER (ORDER BY total_gross_profit DESC NULLS LAST) AS profit_rank,
       RANK() OVER (ORDER BY avg_rating DESC NULLS LAST) AS rating_rank,
       NTILE(4) OVER (ORDER BY gross_revenue DESC NULLS LAST, product_id) AS revenue_quartile,
       CASE WHEN revenue_rank <= 50 AND return_rate_pct < 5 THEN 'STAR'
            WHEN revenue_rank <= 50 AND return_rate_pct >= 5 THEN 'QUESTION_MARK'
            WHEN revenue_rank > 50 AND return_rate_pct < 5 THEN 'CASH_COW' ELSE 'DOG' END AS bcg_quadrant
FROM m_product_performance""")

cte("m_campaign_effectiveness", """
SELECT cam.campaign_id, cam.campaign_name, cam.campaign_type, cam.channel, cam.start_date, cam.end_date,
       cam.campaign_duration_days, cam.budget_amount, cam.spend_amount, cam.impressions, cam.clicks, cam.conversions,
       cam.revenue_attributed, cam.ctr_pct, cam.conversion_rate_pct, cam.cost_per_conversion, cam.roas_pct,
       CAST(COALESCE(s.orders_tracked, 0) AS BIGINT) AS orders_tracked,
       CAST(COALESCE(s.ucr, 0) AS BIGINT) AS unique_customers_reached,
       CAST(COALESCE(r.rev, 0) AS DOUBLE) AS tracked_revenue,
       CASE WHEN s.durn > 0 THEN CAST(s.dur AS DOUBLE) / s.durn END AS avg_session_duration_converted,
       s.total_page_views,
       CASE WHEN s.bn > 0 THEN CAST(s.b AS DOUBLE) / s.bn * 100 END AS bounce_rate_pct,
       CASE WHEN cam.spend_amount > 0 THEN CAST(cam.revenue_attributed AS DOUBLE) / CAST(cam.spend_amount AS DOUBLE) END AS roas_ratio,
       CASE WHEN cam.spend_amount > 0 THEN (CAST(cam.revenue_attributed AS DOUBLE) - CAST(cam.spend_amount AS DOUBLE))
            / CAST(cam.spend_amount AS DOUBLE) * 100 END AS roi_pct,
       RANK() OVER (ORDER BY COALESCE(CASE WHEN cam.spend_amount > 0 THEN CAST(cam.revenue_attributed AS DOUBLE)
            / CAST(cam.spend_amount AS DOUBLE) END, 0) DESC) AS roas_rank
FROM g_dim_campaigns cam
LEFT JOIN (SELECT campaign_id, COUNT(DISTINCT order_id) AS orders_tracked, COUNT(DISTINCT customer_sk) AS ucr,
                  SUM(CASE WHEN converted THEN session_duration_sec END) AS dur,
                  COUNT(CASE WHEN converted THEN session_duration_sec END) AS durn,
                  CAST(SUM(page_views) AS BIGINT) AS total_page_views, SUM(CAST(is_bounce AS INTEGER)) AS b, COUNT(is_bounce) AS bn
           FROM g_fact_web_sessions GROUP BY campaign_id) s ON cam.campaign_id = s.campaign_id
LEFT JOIN (SELECT c.campaign_id, SUM(fs.total_amount) AS rev
           FROM (SELECT DISTINCT campaign_id, order_id FROM g_fact_web_sessions WHERE converted AND order_id IS NOT NULL) c
           JOIN g_fact_sales fs ON c.order_id = fs.order_id GROUP BY c.campaign_id) r ON cam.campaign_id = r.campaign_id""")

cte("m_inventory_health", f"""
SELECT inv.product_id, p.product_name, p.brand, p.category_name, p.supplier_name, inv.location_id, inv.location_type,
       inv.quantity_on_hand, inv.quantity_reserved, inv.quantity_available, inv.reorder_point, inv.reorder_quantity,
       inv.inventory_value, COALESCE(sv.vel, 0.0) AS daily_sales_velocity,
       CASE WHEN sv.vel > 0 THEN CAST(inv.quantity_available AS DOUBLE) / sv.vel END AS days_of_stock,
       inv.is_out_of_stock, inv.is_below_reorder,
       CASE WHEN inv.quantity_available = 0 THEN 'STOCKOUT'
            WHEN inv.quantity_available <= inv.reorder_point THEN 'LOW_STOCK'
            WHEN CASE WHEN sv.vel <> 0 THEN CAST(inv.quantity_available AS DOUBLE) / sv.vel END > 180 THEN 'OVERSTOCK'
            WHEN sv.vel < 0.1 AND inv.quantity_on_hand > 50 THEN 'SLOW_MOVER' ELSE 'HEALTHY' END AS inventory_status,
       inv.snapshot_date
FROM (SELECT * FROM g_fact_inventory_snapshots WHERE snapshot_date = (SELECT MAX(snapshot_date) FROM g_fact_inventory_snapshots)) inv
LEFT JOIN g_dim_products p ON inv.product_id = p.product_id
LEFT JOIN (SELECT product_id, CASE WHEN datediff('day', MIN(order_date), {AS_OF}) <> 0
                  THEN CAST(SUM(quantity) AS DOUBLE) / CAST(datediff('day', MIN(order_date), {AS_OF}) AS DOUBLE) END AS vel
           FROM g_fact_order_items WHERE order_date >= {AS_OF} - 90 GROUP BY product_id) sv ON inv.product_id = sv.product_id""")

cte("m_supplier_performance", """
SELECT s.supplier_id, s.supplier_name, s.country, s.region, s.supplier_rating, s.supplier_status_label,
       s.payment_terms_days, s.lead_time_days AS contracted_lead_days,
       CAST(COALESCE(po.total_po_count, 0) AS BIGINT) AS total_po_count, po.total_units_ordered, po.total_units_received,
       po.total_spend, CAST(COALESCE(po.late_deliveries, 0) AS BIGINT) AS late_deliveries,
       CASE WHEN po.total_po_count > 0 THEN CAST(po.late_deliveries AS DOUBLE) / CAST(po.total_po_count AS DOUBLE) * 100 END AS late_delivery_rate_pct,
       CAST(po.lt AS DOUBLE) / po.ltn AS avg_lead_time_actual,
       CAST(po.dv AS DOUBLE) / po.dvn AS avg_delivery_variance_days,
       CASE WHEN po.total_units_ordered <> 0 THEN CAST(po.total_units_received AS DOUBLE) / CAST(po.total_units_ordered AS DOUBLE) * 100 END AS fill_rate_pct,
       CAST(COALESCE(rc.rc, 0) AS BIGINT) AS returns_from_supplier_products,
       CAST(COALESCE(po.distinct_products, 0) AS BIGINT) AS distinct_products,
       RANK() OVER (ORDER BY s.supplier_rating DESC NULLS LAST) AS rating_rank
FROM g_dim_suppliers s
LEFT JOIN (SELECT supplier_id, COUNT(DISTINCT po_number) AS total_po_count, CAST(SUM(quantity_ordered) AS BIGINT) AS total_units_ordered,
                  CAST(SUM(quantity_received) AS BIGINT) AS total_units_received, SUM(total_cost) AS total_spend,
                  COUNT(DISTINCT CASE WHEN is_late_delivery THEN po_number END) AS late_deliveries,
                  SUM(datediff('day', order_date, actual_delivery)) AS lt, COUNT(datediff('day', order_date, actual_delivery)) AS ltn,
                  SUM(delivery_variance_days) AS dv, COUNT(delivery_variance_days) AS dvn,
                  COUNT(DISTINCT product_id) AS distinct_products
           FROM g_fact_supplier_orders GROUP BY supplier_id) po ON s.supplier_id = po.supplier_id
LEFT JOIN (SELECT sp.supplier_id, COUNT(DISTINCT r.return_id) AS rc
           FROM (SELECT DISTINCT supplier_id, product_id FROM g_fact_supplier_orders) sp
           JOIN (SELECT DISTINCT product_id, order_id FROM g_fact_order_items) l ON sp.product_id = l.product_id
           JOIN g_fact_returns r ON l.order_id = r.order_id GROUP BY sp.supplier_id) rc ON s.supplier_id = rc.supplier_id""")

cte("m_customer_cohort_analysis", """
SELECT g.cohort_month, g.activity_month,
       CAST((year(g.activity_month) - year(g.cohort_month)) * 12 + month(g.activity_month) - month(g.cohort_month) AS BIGINT) AS months_since_first_order,
       sz.cohort_size, g.active_customers,
       CASE WHEN sz.cohort_size > 0 THEN CAST(g.active_customers AS DOUBLE) / CAST(sz.cohort_size AS DOUBLE) * 100 END AS retention_rate_pct,
       CAST(g.rev AS DOUBLE) AS cohort_revenue, g.cohort_orders,
       CASE WHEN g.active_customers > 0 THEN CAST(g.rev AS DOUBLE) / CAST(g.active_customers AS DOUBLE) END AS revenue_per_active_customer
FROM (SELECT fo.cohort_month, oa.activity_month, COUNT(DISTINCT oa.customer_id) AS active_customers, SUM(oa.rev) AS rev,
             CAST(SUM(oa.orders) AS BIGINT) AS cohort_orders
      FROM c_first fo LEFT JOIN c_act oa ON fo.customer_id = oa.customer_id
      GROUP BY fo.cohort_month, oa.activity_month) g
LEFT JOIN (SELECT cohort_month, COUNT(DISTINCT customer_id) AS cohort_size FROM c_first GROUP BY cohort_month) sz
       ON g.cohort_month = sz.cohort_month""")

cte("c_first", """
SELECT customer_id, CAST(date_trunc('month', MIN(order_date)) AS DATE) AS cohort_month
FROM s_orders WHERE order_status NOT IN ('CANCELLED', 'RETURNED') GROUP BY customer_id""")

cte("c_act", """
SELECT customer_id, CAST(date_trunc('month', order_date) AS DATE) AS activity_month, SUM(total_amount) AS rev,
       COUNT(DISTINCT order_id) AS orders
FROM s_orders WHERE order_status NOT IN ('CANCELLED', 'RETURNED') GROUP BY customer_id, CAST(date_trunc('month', order_date) AS DATE)""")

cte("s_customer_segments", f"""
SELECT customer_id, {AS_OF} AS segment_date, recency_days, frequency_orders, CAST(monetary_total AS DECIMAL(18,2)) AS monetary_total,
       r AS rfm_recency_score, f AS rfm_frequency_score, m AS rfm_monetary_score,
       CAST(r AS VARCHAR) || CAST(f AS VARCHAR) || CAST(m AS VARCHAR) AS rfm_combined_score,
       CASE WHEN r >= 4 AND f >= 4 AND m >= 4 THEN 'CHAMPION' WHEN r >= 3 AND f >= 3 THEN 'LOYAL'
            WHEN r <= 2 AND f >= 3 THEN 'AT_RISK' WHEN r = 1 AND f = 1 THEN 'LOST'
            WHEN frequency_orders = 1 THEN 'NEW' ELSE 'POTENTIAL' END AS lifecycle_segment,
       CASE WHEN monetary_total >= 5000 THEN 'HIGH' WHEN monetary_total >= 500 THEN 'MEDIUM' ELSE 'LOW' END AS value_segment,
       channel_preference, monetary_total >= 5000 AND f >= 4 AS is_vip, recency_days > 365 AS has_churned
FROM (SELECT rfm.*, pref.channel_preference,
             NTILE(5) OVER (ORDER BY recency_days DESC NULLS LAST, rfm.customer_id) AS r,
             NTILE(5) OVER (ORDER BY frequency_orders NULLS LAST, rfm.customer_id) AS f,
             NTILE(5) OVER (ORDER BY monetary_total NULLS LAST, rfm.customer_id) AS m
      FROM (SELECT customer_id, CAST(datediff('day', MAX(order_date), {AS_OF}) AS BIGINT) AS recency_days,
                   COUNT(*) AS frequency_orders, SUM(total_amount) AS monetary_total
            FROM s_orders WHERE order_status NOT IN ('CANCELLED', 'RETURNED') GROUP BY customer_id) rfm
      LEFT JOIN (SELECT customer_id, MIN(channel) AS channel_preference FROM (
                   SELECT customer_id, channel, COUNT(*) AS n, MAX(COUNT(*)) OVER (PARTITION BY customer_id) AS mx
                   FROM s_orders WHERE order_status NOT IN ('CANCELLED', 'RETURNED') GROUP BY customer_id, channel)
                 WHERE n = mx GROUP BY customer_id) pref ON rfm.customer_id = pref.customer_id)""")

cte("m_employee_performance", """
SELECT g.*, CAST(COALESCE(cs.customers_served, 0) AS BIGINT) AS customers_served,
       CASE WHEN g.orders_taken > 0 THEN g.total_sales / g.orders_taken END AS avg_transaction_value,
       CASE WHEN g.total_sales <> 0 THEN g.total_discounts_given / g.total_sales * 100 END AS discount_rate_pct,
       RANK() OVER (PARTITION BY g.store_id, g.year_number, g.month_number ORDER BY g.total_sales DESC NULLS LAST) AS store_sales_rank,
       LAG(g.total_sales) OVER (PARTITION BY g.employee_id ORDER BY g.year_number, g.month_number) AS prev_month_sales
FROM (SELECT e.employee_id, e.full_name, e.job_title, e.department, e.store_id, d.year_number, d.month_number, d.month_name,
             CAST(SUM(fes.orders_taken) AS BIGINT) AS orders_taken, round(SUM(fes.total_sales_amount), 2) AS total_sales,
             round(SUM(fes.total_discounts_given), 2) AS total_discounts_given
      FROM g_fact_employee_sales fes JOIN g_dim_employees e ON fes.employee_sk = e.employee_sk
      JOIN g_dim_date d ON fes.date_sk = d.date_sk
      GROUP BY e.employee_id, e.full_name, e.job_title, e.department, e.store_id, d.year_number, d.month_number, d.month_name) g
LEFT JOIN (SELECT l.employee_id, year(o.order_date) AS y, month(o.order_date) AS m, COUNT(DISTINCT o.customer_id) AS customers_served
           FROM s_employee_links l JOIN s_orders o ON l.order_id = o.order_id GROUP BY 1, 2, 3) cs
       ON g.employee_id = cs.employee_id AND g.year_number = cs.y AND g.month_number = cs.m""")

cte("m_seasonal_trends", """
SELECT g.month_number, g.month_name, g.quarter_number, g.quarter_name, g.week_of_year, g.is_holiday, g.holiday_name,
       g.year_number, CAST(g.rev AS DOUBLE) AS total_revenue, g.order_count, CAST(g.rev AS DOUBLE) / g.n AS aov,
       g.unique_customers,
       CASE WHEN CAST(SUM(g.rev) OVER (PARTITION BY g.year_number) AS DOUBLE) / COUNT(g.rev) OVER (PARTITION BY g.year_number) <> 0
            THEN CAST(g.rev AS DOUBLE) / (CAST(SUM(g.rev) OVER (PARTITION BY g.year_number) AS DOUBLE)
                 / COUNT(g.rev) OVER (PARTITION BY g.year_number)) * 100 END AS revenue_seasonality_index,
       CAST(ly.wrev AS DOUBLE) AS same_week_ly_revenue, wk.revenue_4w_ma
FROM (SELECT d.month_number, d.month_name, d.quarter_number, d.quarter_name, d.week_of_year, d.is_holiday, d.holiday_name,
             d.year_number, SUM(fs.total_amount) AS rev, COUNT(DISTINCT fs.order_id) AS order_count,
             COUNT(fs.total_amount) AS n, COUNT(DISTINCT fs.customer_id) AS unique_customers
      FROM g_fact_sales fs JOIN g_dim_date d ON fs.date_sk = d.date_sk
      GROUP BY d.month_number, d.month_name, d.quarter_number, d.quarter_name, d.week_of_year, d.is_holiday,
               d.holiday_name, d.year_number) g
LEFT JOIN (SELECT year_number, week_of_year, wrev,
                  CAST(SUM(wrev) OVER w AS DOUBLE) / COUNT(wrev) OVER w AS revenue_4w_ma
           FROM st_weeks WINDOW w AS (ORDER BY year_number, week_of_year ROWS BETWEEN 3 PRECEDING AND CURRENT ROW)) wk
       ON g.year_number = wk.year_number AND g.week_of_year = wk.week_of_year
LEFT JOIN st_weeks ly ON ly.year_number + 1 = g.year_number AND ly.week_of_year = g.week_of_year""")

cte("st_weeks", """
SELECT d.year_number, d.week_of_year, SUM(fs.total_amount) AS wrev
FROM g_fact_sales fs JOIN g_dim_date d ON fs.date_sk = d.date_sk GROUP BY d.year_number, d.week_of_year""")

cte("m_geographic_performance", """
SELECT country_code, state_province, city, year_number, quarter_name, month_number, orders, unique_customers,
       CAST(rev AS DOUBLE) AS gross_revenue, CAST(net AS DOUBLE) AS net_revenue, CAST(rev AS DOUBLE) / n AS aov,
       CAST(disc AS DOUBLE) AS total_discounts,
       CASE WHEN SUM(rev) OVER (PARTITION BY year_number, month_number, country_code) <> 0
            THEN CAST(SUM(rev) OVER (PARTITION BY year_number, month_number, country_code, state_province) AS DOUBLE)
                 / CAST(SUM(rev) OVER (PARTITION BY year_number, month_number, country_code) AS DOUBLE) * 100 END AS state_share_of_country_pct,
       RANK() OVER (PARTITION BY year_number, month_number ORDER BY rev DESC NULLS LAST) AS revenue_rank
FROM (SELECT a.country_code, a.state_province, a.city, d.year_number, d.quarter_name, d.month_number,
             COUNT(DISTINCT fs.order_id) AS orders, COUNT(DISTINCT fs.customer_id) AS unique_customers,
             SUM(fs.total_amount) AS rev, SUM(fs.net_revenue) AS net, COUNT(fs.total_amount) AS n,
             SUM(fs.discount_amount) AS disc
      FROM g_fact_sales fs JOIN g_dim_customers c ON fs.customer_sk = c.customer_sk
      JOIN (SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY customer_id ORDER BY is_default DESC, address_id) AS rn
                           FROM g_dim_addresses WHERE address_type IN ('SHIPPING', 'BOTH')) WHERE rn = 1) a
        ON c.customer_id = a.customer_id
      JOIN g_dim_date d ON fs.date_sk = d.date_sk
      GROUP BY a.country_code, a.state_province, a.city, d.year_number, d.quarter_name, d.month_number)""")

cte("m_channel_attribution", """
SELECT channel, year_number, quarter_name, month_number, month_name, orders, unique_customers, new_customers_acquired,
       CAST(rev AS DOUBLE) AS gross_revenue, CAST(net AS DOUBLE) AS net_revenue, CAST(rev AS DOUBLE) / n AS aov,
       CAST(disc AS DOUBLE) AS total_discounts,
       CASE WHEN SUM(rev) OVER p <> 0 THEN CAST(rev AS DOUBLE) / CAST(SUM(rev) OVER p AS DOUBLE) * 100 END AS channel_revenue_share_pct,
       CASE WHEN SUM(new_customers_acquired) OVER p <> 0
            THEN CAST(new_customers_acquired AS DOUBLE) / CAST(SUM(new_customers_acquired) OVER p AS DOUBLE) * 100 END AS new_customer_share_pct,
       CASE WHEN rev <> 0 THEN CAST(ret AS DOUBLE) / CAST(rev AS DOUBLE) * 100 END AS return_rate_pct
FROM (SELECT fs.channel, d.year_number, d.quarter_name, d.month_number, d.month_name,
             COUNT(DISTINCT fs.order_id) AS orders, COUNT(DISTINCT fs.customer_id) AS unique_customers,
             COUNT(DISTINCT CASE WHEN fs.is_first_order THEN fs.customer_id END) AS new_customers_acquired,
             SUM(fs.total_amount) AS rev, SUM(fs.net_revenue) AS net, COUNT(fs.total_amount) AS n,
             SUM(fs.discount_amount) AS disc,
             SUM(CASE WHEN fs.order_status = 'RETURNED' THEN fs.total_amount ELSE 0 END) AS ret
      FROM g_fact_sales fs JOIN g_dim_date d ON fs.date_sk = d.date_sk
      GROUP BY fs.channel, d.year_number, d.quarter_name, d.month_number, d.month_name)
WINDOW p AS (PARTITION BY year_number, month_number)""")

cte("m_promotion_roi", """
SELECT p.promotion_id, p.promotion_name, p.promotion_type, p.promo_code, p.start_date, p.end_date, p.discount_value,
       p.usage_limit, CAST(COALESCE(u.times_used, 0) AS BIGINT) AS times_used,
       CAST(COALESCE(u.ucu, 0) AS BIGINT) AS unique_customers_using,
       CAST(COALESCE(u.nca, 0) AS BIGINT) AS new_customers_acquired,
       CAST(u.basket AS DOUBLE) AS total_basket_value, CAST(u.disc AS DOUBLE) AS total_discount_cost,
       CAST(u.tot AS DOUBLE) AS net_revenue_after_discount, u.avg_effective_discount_pct,
       CAST(u.basket AS DOUBLE) / u.bn AS avg_basket_size,
       CASE WHEN u.disc <> 0 THEN CAST(u.tot AS DOUBLE) / CAST(u.disc AS DOUBLE) END AS revenue_per_discount_dollar,
       CASE WHEN u.disc <> 0 THEN (CAST(u.tot AS DOUBLE) - CAST(u.disc AS DOUBLE)) / CAST(u.disc AS DOUBLE) * 100 END AS promotion_roi_pct,
       RANK() OVER (ORDER BY CASE WHEN u.disc <> 0 THEN (CAST(u.tot AS DOUBLE) - CAST(u.disc AS DOUBLE)) / CAST(u.disc AS DOUBLE) * 100 END
                    DESC NULLS LAST) AS roi_rank
FROM g_dim_promotions p
LEFT JOIN (SELECT promotion_id, COUNT(DISTINCT order_id) AS times_used, COUNT(DISTINCT customer_id) AS ucu,
                  COUNT(DISTINCT CASE WHEN is_first_order THEN customer_id END) AS nca,
                  SUM(subtotal_amount) AS basket, COUNT(subtotal_amount) AS bn, SUM(actual_discount_given) AS disc,
                  SUM(total_amount) AS tot, round(AVG(effective_discount_pct), 6) AS avg_effective_discount_pct
           FROM g_fact_promotions_usage GROUP BY promotion_id) u ON p.promotion_id = u.promotion_id""")

cte("m_customer_churn_indicators", f"""
SELECT c.customer_sk, cm.customer_id, c.full_name, c.customer_tier, cm.total_orders, CAST(cm.rev AS DOUBLE) AS lifetime_revenue,
       cm.last_order_date, CAST(datediff('day', cm.last_order_date, {AS_OF}) AS BIGINT) AS recency_days,
       cm.avg_days_between_orders, cm.active_months, CAST(COALESCE(sm.sess, 0) AS BIGINT) AS sessions_last_90d,
       sm.last_visit_date, COALESCE(sm.last_visit_date, cm.last_order_date) AS last_activity_date,
       CAST(LEAST(100, CASE WHEN datediff('day', cm.last_order_date, {AS_OF}) > 365 THEN 50
                            WHEN datediff('day', cm.last_order_date, {AS_OF}) > 180 THEN 35
                            WHEN datediff('day', cm.last_order_date, {AS_OF}) > 90 THEN 20 ELSE 0 END
                     + CASE WHEN COALESCE(sm.sess, 0) = 0 THEN 25 WHEN sm.sess <= 2 THEN 15 ELSE 0 END
                     + CASE WHEN cm.total_orders = 1 THEN 15 WHEN cm.total_orders <= 3 THEN 10 ELSE 0 END) AS BIGINT) AS churn_score,
       CASE WHEN datediff('day', cm.last_order_date, {AS_OF}) > 365 THEN 'CHURNED'
            WHEN datediff('day', cm.last_order_date, {AS_OF}) > 180 OR COALESCE(sm.sess, 0) = 0 THEN 'HIGH_RISK'
            WHEN datediff('day', cm.last_order_date, {AS_OF}) > 90 THEN 'AT_RISK' ELSE 'ACTIVE' END AS churn_segment
FROM (SELECT customer_id, COUNT(DISTINCT order_id) AS total_orders, SUM(total_amount) AS rev,
             MAX(order_date) AS last_order_date, AVG(gap) AS avg_days_between_orders,
             COUNT(DISTINCT date_trunc('month', order_date)) AS active_months
      FROM (SELECT *, datediff('day', LAG(order_date) OVER (PARTITION BY customer_id ORDER BY order_date), order_date) AS gap
            FROM s_orders WHERE order_status NOT IN ('CANCELLED'))
      GROUP BY customer_id) cm
LEFT JOIN (SELECT customer_id, COUNT(DISTINCT session_id) AS sess, MAX(CAST(session_start AS DATE)) AS last_visit_date
           FROM s_web_sessions WHERE session_start >= CAST({AS_OF} - 90 AS TIMESTAMP) GROUP BY customer_id) sm
       ON cm.customer_id = sm.customer_id
LEFT JOIN cur_cust_full c ON cm.customer_id = c.customer_id""")

cte("m_product_affinity", f"""
SELECT ccs.customer_id, c.full_name, c.customer_tier, ccs.category, CAST(ccs.spend AS DOUBLE) AS category_spend,
       ccs.category_orders, ccs.units_bought, ccs.last_purchase_in_category, CAST(ct.total AS DOUBLE) AS total_spend,
       CASE WHEN ct.total <> 0 THEN CAST(ccs.spend AS DOUBLE) / CAST(ct.total AS DOUBLE) * 100 END AS category_spend_share_pct,
       RANK() OVER (PARTITION BY ccs.customer_id ORDER BY ccs.spend DESC NULLS LAST) AS category_rank_for_customer,
       CASE WHEN ct.total <> 0 THEN LEAST(100.0, CAST(ccs.spend AS DOUBLE) / CAST(ct.total AS DOUBLE) * 100
            + CASE WHEN datediff('day', ccs.last_purchase_in_category, {AS_OF}) <= 30 THEN 10
                   WHEN datediff('day', ccs.last_purchase_in_category, {AS_OF}) <= 90 THEN 5 ELSE 0 END) END AS affinity_score
FROM (SELECT foi.customer_id, p.top_category_name AS category, SUM(foi.line_total) AS spend,
             COUNT(DISTINCT foi.order_id) AS category_orders, CAST(SUM(foi.quantity) AS BIGINT) AS units_bought,
             MAX(foi.order_date) AS last_purchase_in_category
      FROM g_fact_order_items foi JOIN g_dim_products p ON foi.product_id = p.product_id
      GROUP BY foi.customer_id, p.top_category_name) ccs
JOIN (SELECT customer_id, SUM(spend) AS total FROM (
        SELECT foi.customer_id, p.top_category_name, SUM(foi.line_total) AS spend
        FROM g_fact_order_items foi JOIN g_dim_products p ON foi.product_id = p.product_id GROUP BY 1, 2) GROUP BY customer_id) ct
  ON ccs.customer_id = ct.customer_id
LEFT JOIN cur_cust_full c ON ccs.customer_id = c.customer_id""")

cte("m_net_promoter_score", """
SELECT review_month, top_category_name, category_name,
       CAST(GROUPING(review_month, top_category_name, category_name) AS BIGINT) AS grouping_level,
       CAST(COUNT(*) AS BIGINT) AS total_responses,
       CAST(SUM(CASE WHEN rating >= 4 THEN 1 ELSE 0 END) AS BIGINT) AS promoters,
       CAST(SUM(CASE WHEN rating > 2 AND rating < 4 THEN 1 ELSE 0 END) AS BIGINT) AS passives,
       CAST(SUM(CASE WHEN rating <= 2 THEN 1 ELSE 0 END) AS BIGINT) AS detractors,
       CAST(SUM(CASE WHEN is_verified_purchase THEN 1 ELSE 0 END) AS BIGINT) AS verified_responses,
       CASE WHEN COUNT(*) <> 0 THEN (CAST(SUM(CASE WHEN rating >= 4 THEN 1 ELSE 0 END) AS DOUBLE)
            - CAST(SUM(CASE WHEN rating <= 2 THEN 1 ELSE 0 END) AS DOUBLE)) / CAST(COUNT(*) AS DOUBLE) * 100 END AS nps_score,
       CAST(SUM(rating) AS DOUBLE) / COUNT(rating) AS avg_rating,
       CASE WHEN SUM(CASE WHEN is_verified_purchase THEN 1 ELSE 0 END) <> 0
            THEN (CAST(SUM(CASE WHEN rating >= 4 AND is_verified_purchase THEN 1 ELSE 0 END) AS DOUBLE)
                  - CAST(SUM(CASE WHEN rating <= 2 AND is_verified_purchase THEN 1 ELSE 0 END) AS DOUBLE))
                 / CAST(SUM(CASE WHEN is_verified_purchase THEN 1 ELSE 0 END) AS DOUBLE) * 100 END AS verified_nps_score
FROM (SELECT r.*, CAST(date_trunc('month', r.review_date) AS DATE) AS review_month, p.category_name, p.top_category_name
      FROM g_fact_reviews r JOIN g_dim_products p ON r.product_id = p.product_id)
GROUP BY ROLLUP (review_month, top_category_name, category_name)""")

cte("m_fulfillment_metrics", """
SELECT sh.carrier, sh.shipping_method, sh.destination_country, d.year_number, d.quarter_name, d.month_number, d.month_name,
       COUNT(DISTINCT sh.shipment_id) AS total_shipments,
       COUNT(DISTINCT CASE WHEN sh.actual_delivery IS NOT NULL THEN sh.shipment_id END) AS delivered,
       COUNT(DISTINCT CASE WHEN sh.is_late THEN sh.shipment_id END) AS late_deliveries,
       CASE WHEN COUNT(DISTINCT CASE WHEN sh.actual_delivery IS NOT NULL THEN sh.shipment_id END) <> 0
            THEN CAST(COUNT(DISTINCT CASE WHEN sh.is_late THEN sh.shipment_id END) AS DOUBLE)
                 / CAST(COUNT(DISTINCT CASE WHEN sh.actual_delivery IS NOT NULL THEN sh.shipment_id END) AS DOUBLE) * 100 END AS late_delivery_rate_pct,
       CAST(SUM(sh.days_to_deliver) AS DOUBLE) / COUNT(sh.days_to_deliver) AS avg_days_to_deliver,
       round(quantile_cont(sh.days_to_deliver, 0.5), 6) AS median_days_to_deliver,
       round(quantile_cont(sh.days_to_deliver, 0.9), 6) AS p90_days_to_deliver,
       CAST(SUM(sh.days_late) AS DOUBLE) / COUNT(sh.days_late) AS avg_days_late,
       CAST(SUM(sh.shipping_cost) AS DOUBLE) AS total_shipping_cost,
       CAST(SUM(sh.shipping_cost) AS DOUBLE) / COUNT(sh.shipping_cost) AS avg_shipping_cost,
       CASE WHEN SUM(sh.weight_kg) <> 0 THEN CAST(SUM(sh.shipping_cost) AS DOUBLE) / CAST(SUM(sh.weight_kg) AS DOUBLE) END AS cost_per_kg,
       CAST(SUM(CASE WHEN NOT sh.is_late OR sh.is_late IS NULL THEN 1 ELSE 0 END) AS DOUBLE) / COUNT(*) * 100 AS on_time_delivery_pct
FROM g_fact_shipments sh JOIN g_dim_date d ON sh.ship_date_sk = d.date_sk
GROUP BY sh.carrier, sh.shipping_method, sh.destination_country, d.year_number, d.quarter_name, d.month_number, d.month_name""")

cte("m_loyalty_program_performance", """
SELECT *, CAST(points_earned AS DOUBLE) * 0.01 AS estimated_points_liability_earned,
       CAST(points_redeemed AS DOUBLE) * 0.01 AS estimated_points_redeemed_value,
       CASE WHEN points_redeemed + points_expired <> 0
            THEN CAST(points_redeemed AS DOUBLE) / CAST(points_redeemed + points_expired AS DOUBLE) * 100 END AS redemption_rate_pct
FROM (SELECT d.year_number, d.month_number, d.month_name, d.month_start_date, flt.transaction_type,
             COUNT(DISTINCT flt.transaction_id) AS transactions, COUNT(DISTINCT flt.customer_id) AS active_members,
             CAST(SUM(flt.points_change) AS BIGINT) AS total_points_change,
             CAST(SUM(CASE WHEN flt.points_change > 0 THEN flt.points_change ELSE 0 END) AS BIGINT) AS points_earned,
             CAST(SUM(CASE WHEN flt.transaction_type = 'REDEEM' THEN abs(flt.points_change) ELSE 0 END) AS BIGINT) AS points_redeemed,
             CAST(SUM(CASE WHEN flt.transaction_type = 'EXPIRE' THEN abs(flt.points_change) ELSE 0 END) AS BIGINT) AS points_expired,
             CAST(SUM(flt.points_balance_after) AS DOUBLE) / COUNT(flt.points_balance_after) AS avg_member_balance
      FROM g_fact_loyalty_transactions flt JOIN g_dim_date d ON flt.date_sk = d.date_sk
      GROUP BY d.year_number, d.month_number, d.month_name, d.month_start_date, flt.transaction_type)""")

NODE_CASE = ("CASE user_id % 5 WHEN 0 THEN 'node-substation-north' WHEN 1 THEN 'node-substation-south' "
             "WHEN 2 THEN 'node-distribution-east' WHEN 3 THEN 'node-distribution-west' ELSE 'node-unregistered' END")

cte("t_readings", f"""
SELECT {NODE_CASE} AS node_id, ts AS timestamp,
       CAST(CASE WHEN user_id % 5 <= 1 THEN 132.0 ELSE 11.0 END AS DOUBLE) * (1.0 + (value - 150.0) / 3000.0) AS voltage_kv,
       fmod(value, 101.0) AS load_pct, 50.0 + CAST((event_id % 21) - 10 AS DOUBLE) / 10.0 AS frequency_hz,
       CAST(CASE WHEN user_id % 5 <= 1 THEN 132.0 ELSE 11.0 END AS DOUBLE) AS nominal_voltage_kv,
       CAST(50.0 AS DOUBLE) AS nominal_frequency_hz
FROM events""")

cte("t_eval", """
SELECT *, (CASE WHEN vpct > 5.0 THEN 1 ELSE 0 END) + (CASE WHEN load_pct > 90.0 THEN 1 ELSE 0 END)
          + (CASE WHEN fdev > 0.5 THEN 1 ELSE 0 END) AS n_issues
FROM (SELECT *, abs(voltage_kv - nominal_voltage_kv) / greatest(nominal_voltage_kv, 1.0) * 100.0 AS vpct,
             abs(frequency_hz - nominal_frequency_hz) AS fdev
      FROM t_readings WHERE voltage_kv IS NOT NULL AND NOT isnan(voltage_kv) AND load_pct IS NOT NULL
        AND NOT isnan(load_pct) AND frequency_hz IS NOT NULL AND NOT isnan(frequency_hz))""")

cte("m_grid_reading_status", """
SELECT node_id, timestamp, voltage_kv, load_pct, frequency_hz, nominal_voltage_kv, nominal_frequency_hz,
       CAST(n_issues AS BIGINT) AS issue_count, CASE WHEN n_issues > 0 THEN 'WARNING' ELSE 'NOMINAL' END AS status
FROM t_eval""")

cte("m_grid_alerts", """
SELECT node_id, timestamp, CASE WHEN load_pct >= 98.0 OR n_issues >= 3 THEN 'CRITICAL'
                                WHEN load_pct >= 90.0 OR n_issues >= 2 THEN 'HIGH' ELSE 'MEDIUM' END AS severity,
       CAST(n_issues AS BIGINT) AS issue_count, vpct > 5.0 AS voltage_breach, load_pct > 90.0 AS load_breach,
       fdev > 0.5 AS frequency_breach, voltage_kv, load_pct, frequency_hz
FROM t_eval WHERE n_issues > 0""")

cte("rr_lines", """
SELECT foi.order_id, foi.line_total, CAST(foi.line_total * 10000 AS BIGINT) AS line_u, p.category_name,
       p.top_category_name, p.brand, d.year_number, d.quarter_name, d.month_name
FROM g_fact_order_items foi JOIN g_dim_products p ON foi.product_id = p.product_id
JOIN g_dim_date d ON foi.date_sk = d.date_sk""")

cte("m_return_rate_analysis", """
SELECT n.year_number, n.quarter_name, n.month_name, n.category_name, n.top_category_name, n.brand, n.return_reason,
       n.total_returns, den.total_orders_in_period, CAST(n.refund / 100 AS DECIMAL(20,2)) AS total_refund_amount,
       CASE WHEN den.total_orders_in_period <> 0 THEN CAST(n.total_returns AS DOUBLE) / CAST(den.total_orders_in_period AS DOUBLE) * 100 END AS order_return_rate_pct,
       CASE WHEN den.slice_rev <> 0 THEN CAST(n.refund AS DOUBLE) / (CAST(den.slice_rev AS DOUBLE) * 100) * 100 END AS revenue_return_rate_pct,
       CAST(n.ds AS DOUBLE) / n.dn AS avg_days_to_return,
       CAST(n.card / 100 AS DECIMAL(20,2)) AS refunded_to_card, CAST(n.credit / 100 AS DECIMAL(20,2)) AS refunded_as_credit
FROM (SELECT year_number, quarter_name, month_name, category_name, top_category_name, brand, return_reason,
             COUNT(DISTINCT return_id) AS total_returns, CAST(SUM(a) AS DECIMAL(38,0)) AS refund, SUM(days) AS ds, COUNT(days) AS dn,
             CAST(SUM(CASE WHEN m = 'ORIGINAL_PAYMENT' THEN a ELSE 0 END) AS DECIMAL(38,0)) AS card,
             CAST(SUM(CASE WHEN m = 'STORE_CREDIT' THEN a ELSE 0 END) AS DECIMAL(38,0)) AS credit
      FROM (SELECT l.year_number, l.quarter_name, l.month_name, l.category_name, l.top_category_name, l.brand,
                   r.return_reason, r.return_id,
                   SUM(CASE WHEN t.order_total <> 0 THEN (2 * CAST(r.refund_amount * 100 AS BIGINT) * l.line_u + t.order_total)
                            // (2 * t.order_total) END) AS a,
                   MAX(r.days_to_return) AS days, MAX(r.refund_method) AS m
            FROM g_fact_returns r JOIN rr_lines l ON r.order_id = l.order_id
            JOIN (SELECT order_id, SUM(line_u) AS order_total FROM rr_lines GROUP BY order_id) t ON r.order_id = t.order_id
            GROUP BY 1, 2, 3, 4, 5, 6, 7, 8)
      GROUP BY 1, 2, 3, 4, 5, 6, 7) n
JOIN (SELECT year_number, quarter_name, month_name, category_name, top_category_name, brand,
             COUNT(DISTINCT order_id) AS total_orders_in_period, SUM(line_total) AS slice_rev
      FROM rr_lines GROUP BY 1, 2, 3, 4, 5, 6) den
  USING (year_number, quarter_name, month_name, category_name, top_category_name, brand)""")

cte("m_executive_dashboard", f"""
SELECT {AS_OF} AS report_date, CAST(date_trunc('month', {AS_OF}) AS DATE) AS cur_month,
       CAST(s.mtd_revenue AS DOUBLE) AS mtd_revenue, s.mtd_orders, s.mtd_customers,
       CASE WHEN s.mn > 0 THEN CAST(s.mtd_revenue AS DOUBLE) / s.mn END AS mtd_aov,
       CAST(s.prev AS DOUBLE) AS prev_month_revenue,
       CASE WHEN s.prev <> 0 THEN (CAST(s.mtd_revenue AS DOUBLE) - CAST(s.prev AS DOUBLE)) / CAST(s.prev AS DOUBLE) * 100 END AS revenue_mom_pct,
       CAST(s.ly AS DOUBLE) AS same_month_ly_revenue,
       CASE WHEN s.ly <> 0 THEN (CAST(s.mtd_revenue AS DOUBLE) - CAST(s.ly AS DOUBLE)) / CAST(s.ly AS DOUBLE) * 100 END AS revenue_yoy_pct,
       CAST(s.ytd AS DOUBLE) AS ytd_revenue, s.ytd_orders,
       (SELECT COUNT(DISTINCT customer_id) FROM s_orders WHERE order_date >= {AS_OF} - 90) AS active_customers_90d,
       (SELECT CAST(SUM(total_amount) AS DOUBLE) FROM s_orders WHERE order_status NOT IN ('CANCELLED', 'RETURNED')) AS total_customer_lifetime_revenue,
       (SELECT CAST(SUM(inventory_value) AS DOUBLE) FROM g_fact_inventory_snapshots
        WHERE snapshot_date = (SELECT MAX(snapshot_date) FROM g_fact_inventory_snapshots)) AS current_inventory_value,
       (SELECT CASE WHEN COUNT(DISTINCT o.order_id) > 0 THEN CAST(COUNT(DISTINCT CASE WHEN r.order_id IS NOT NULL THEN o.order_id END) AS DOUBLE)
                    / CAST(COUNT(DISTINCT o.order_id) AS DOUBLE) * 100 END
        FROM s_orders o LEFT JOIN (SELECT DISTINCT order_id FROM s_returns) r ON o.order_id = r.order_id
        WHERE o.order_date >= {AS_OF} - 30) AS return_rate_30d_pct,
       (SELECT MAX(nps_score) FROM m_net_promoter_score WHERE grouping_level = 3
          AND review_month = CAST(date_trunc('month', {AS_OF}) - INTERVAL 1 MONTH AS DATE)) AS overall_nps_prev_month,
       (SELECT COUNT(DISTINCT customer_id) FROM s_loyalty_points) AS total_loyalty_members
FROM (SELECT SUM(CASE WHEN date_trunc('month', order_date) = date_trunc('month', {AS_OF}) THEN total_amount END) AS mtd_revenue,
             COUNT(DISTINCT CASE WHEN date_trunc('month', order_date) = date_trunc('month', {AS_OF}) THEN order_id END) AS mtd_orders,
             COUNT(DISTINCT CASE WHEN date_trunc('month', order_date) = date_trunc('month', {AS_OF}) THEN customer_id END) AS mtd_customers,
             COUNT(CASE WHEN date_trunc('month', order_date) = date_trunc('month', {AS_OF}) THEN total_amount END) AS mn,
             SUM(CASE WHEN date_trunc('month', order_date) = date_trunc('month', {AS_OF}) - INTERVAL 1 MONTH THEN total_amount END) AS prev,
             SUM(CASE WHEN date_trunc('month', order_date) = date_trunc('month', {AS_OF}) - INTERVAL 12 MONTH THEN total_amount END) AS ly,
             SUM(CASE WHEN order_date >= date_trunc('year', {AS_OF}) THEN total_amount END) AS ytd,
             COUNT(DISTINCT CASE WHEN order_date >= date_trunc('year', {AS_OF}) THEN order_id END) AS ytd_orders
      FROM g_fact_sales) s""")

cte("t_transitions", """
SELECT node_id, timestamp, w,
       CASE WHEN w = 1 AND COALESCE(LAG(w) OVER o, 0) = 0 THEN 1 ELSE 0 END AS is_start,
       CASE WHEN w = 0 AND COALESCE(LAG(w) OVER o, 0) = 1 THEN 1 ELSE 0 END AS is_end
FROM (SELECT node_id, timestamp, voltage_kv, load_pct, frequency_hz, CASE WHEN n_issues > 0 THEN 1 ELSE 0 END AS w
      FROM t_eval)
WINDOW o AS (PARTITION BY node_id ORDER BY timestamp, voltage_kv, load_pct, frequency_hz)""")

cte("m_grid_outages", """
SELECT s.node_id || '-' || CAST(s.k AS VARCHAR) AS event_id, s.node_id, s.timestamp AS start_time, e.timestamp AS end_time,
       [CASE s.node_id WHEN 'node-substation-north' THEN 'north' WHEN 'node-substation-south' THEN 'south'
             WHEN 'node-distribution-east' THEN 'east' WHEN 'node-distribution-west' THEN 'west' ELSE 'default' END] AS affected_areas,
       'THRESHOLD_BREACH' AS cause, e.timestamp IS NULL AS is_active
FROM (SELECT node_id, timestamp, ROW_NUMBER() OVER (PARTITION BY node_id ORDER BY timestamp) AS k
      FROM t_transitions WHERE is_start = 1) s
LEFT JOIN (SELECT node_id, timestamp, ROW_NUMBER() OVER (PARTITION BY node_id ORDER BY timestamp) AS k
           FROM t_transitions WHERE is_end = 1) e
  ON s.node_id = e.node_id AND s.k = e.k""")

cte("m_raw_orders", """
SELECT CAST(o_orderkey AS VARCHAR) AS src_order_id, 'testdata/orders' AS file_name,
       CAST(NULL AS BIGINT) AS file_row_number, TIMESTAMP '2001-08-01 01:00:00' AS load_timestamp, 'b1' AS batch_id
FROM orders""")

cte("m_raw_cart_events", """
SELECT src_session_id, src_customer_id, event_type, 'testdata/cart_events' AS file_name,
       CAST(NULL AS BIGINT) AS file_row_number, load_timestamp, CAST(NULL AS VARCHAR) AS batch_id
FROM raw_cart_events""")


def _basket(least: int) -> str:
    return f"""
SELECT a AS product_a_id, pa.product_name AS product_a_name, b AS product_b_id, pb.product_name AS product_b_name, n AS co_occurrence_count,
       total AS total_orders, CAST(n AS DOUBLE) / total AS support, CAST(n AS DOUBLE) / tb.orders AS confidence_a_given_b,
       CAST(n AS DOUBLE) / ta.orders AS confidence_b_given_a, CAST(n * total AS DOUBLE) / CAST(ta.orders * tb.orders AS DOUBLE) AS lift
FROM (SELECT x.product_id AS a, y.product_id AS b, COUNT(*) AS n FROM c_bought x JOIN c_bought y ON x.order_id = y.order_id AND x.product_id < y.product_id
      GROUP BY ALL HAVING COUNT(*) >= {least}) p
JOIN c_bought_by ta ON ta.product_id = a JOIN c_bought_by tb ON tb.product_id = b
JOIN g_dim_products pa ON pa.product_id = a JOIN g_dim_products pb ON pb.product_id = b
CROSS JOIN (SELECT COUNT(DISTINCT order_id) AS total FROM g_fact_order_items)
ORDER BY lift DESC, a, b LIMIT 10000"""


cte("c_bought", "SELECT DISTINCT order_id, product_id FROM g_fact_order_items WHERE order_id IS NOT NULL AND product_id IS NOT NULL")
cte("c_bought_by", "SELECT product_id, COUNT(*) AS orders FROM c_bought GROUP BY product_id")
cte("m_basket_analysis", _basket(5))
cte("m_basket_analysis_pairs", _basket(2))

cte("m_payments_second_load", """
SELECT payment_sk, payment_id, order_id, customer_id, payment_method,
       CASE WHEN payment_id LIKE 'PAY%' AND CAST(order_id AS BIGINT) % 11 = 0 THEN 'SETTLED' ELSE payment_status END AS payment_status,
       amount, currency_code, payment_timestamp, gateway_reference, is_refund, original_payment_id
FROM s_payments
UNION ALL
SELECT (SELECT MAX(payment_sk) FROM s_payments) + ROW_NUMBER() OVER (ORDER BY 'TIP' || CAST(o_orderkey AS VARCHAR)), 'TIP' || CAST(o_orderkey AS VARCHAR),
       CAST(o_orderkey AS VARCHAR), CAST(o_custkey AS VARCHAR), 'CREDIT_CARD', 'CAPTURED', CAST(o_orderkey % 40 AS DECIMAL(18,2)), 'USD',
       o_orderdate + INTERVAL 20 DAY, 'GX' || CAST(o_orderkey AS VARCHAR), FALSE, NULL
FROM orders WHERE o_orderkey % 13 = 0""")
