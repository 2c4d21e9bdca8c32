"""DuckDB oracle: the silver tables re-derived directly from the driver's
test tables with the same binding rules as ``strata.sources.feeds`` and the
same cleaning rules as ``strata.plans.silver`` -- written independently, as
plain SQL, so that a Spark result can be checked against it.

``with_ctes(sql)`` prefixes a query with every CTE it (transitively) names.
"""

from __future__ import annotations

import re

RUN1 = "TIMESTAMP '2001-08-01 01:00:00'"
RUN2 = "TIMESTAMP '2001-08-01 02:00:00'"
SRUN = "TIMESTAMP '2024-01-31 00:00:00'"
EOT = "TIMESTAMP '9999-12-31 00:00:00'"
AS_OF = "DATE '2001-08-01'"

CTES: dict[str, str] = {}


def cte(name: str, sql: str) -> None:
    CTES[name] = sql


cte("o_line_sums", """
SELECT l_orderkey,
       CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_discount AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS disc,
       CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_tax AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS tax
FROM lineitem GROUP BY l_orderkey""")

cte("o_totals", """
SELECT o.o_orderkey,
       CAST(CAST(o.o_totalprice AS DECIMAL(18,2)) - COALESCE(ls.disc, 0) + COALESCE(ls.tax, 0)
            + CASE WHEN o.o_orderkey % 4 <> 0 THEN CAST(o.o_orderkey % 50 AS DECIMAL(18,2)) + CAST(0.99 AS DECIMAL(18,2)) ELSE 0 END
            AS DECIMAL(18,2)) AS total
FROM orders o LEFT JOIN o_line_sums ls ON o.o_orderkey = ls.l_orderkey""")

cte("s_orders_base", """
SELECT CAST(o.o_orderkey AS VARCHAR) AS order_id,
       CAST(o.o_custkey AS VARCHAR) AS customer_id,
       'S' || CAST(c.c_nationkey AS VARCHAR) AS store_id,
       CAST(o.o_orderdate AS DATE) AS order_date,
       o.o_orderdate + to_seconds(CAST(o.o_orderkey % 86400 AS BIGINT)) AS order_timestamp,
       CASE WHEN o.o_orderkey % 20 = 0 THEN 'CANCELLED' WHEN o.o_orderkey % 20 = 1 THEN 'RETURNED'
            WHEN o.o_orderstatus = 'F' THEN 'DELIVERED' WHEN o.o_orderstatus = 'O' THEN 'SHIPPED'
            ELSE 'PENDING' END AS order_status,
       CASE substr(o.o_orderpriority, 1, 1) WHEN '2' THEN 'MOBILE' WHEN '3' THEN 'STORE' WHEN '4' THEN 'PHONE'
            ELSE 'WEB' END AS channel,
       'USD' AS currency_code,
       CAST(o.o_totalprice AS DECIMAL(18,2)) AS subtotal_amount,
       CAST(COALESCE(ls.disc, 0) AS DECIMAL(18,2)) AS discount_amount,
       CAST(COALESCE(ls.tax, 0) AS DECIMAL(18,2)) AS tax_amount,
       CAST(CASE WHEN o.o_orderkey % 4 <> 0 THEN CAST(o.o_orderkey % 50 AS DECIMAL(18,2)) + CAST(0.99 AS DECIMAL(18,2)) ELSE 0 END AS DECIMAL(18,2)) AS shipping_amount,
       t.total AS total_amount,
       CASE WHEN o.o_orderkey % 3 = 0 THEN 'P' || CAST(o.o_orderkey % 8 AS VARCHAR) END AS promotion_id,
       CASE WHEN substr(o.o_orderpriority, 1, 1) = '3' THEN 'E' || CAST(o.o_custkey % 40 AS VARCHAR) END AS employee_id
FROM orders o
LEFT JOIN customer c ON o.o_custkey = c.c_custkey
LEFT JOIN o_line_sums ls ON o.o_orderkey = ls.l_orderkey
LEFT JOIN o_totals t ON o.o_orderkey = t.o_orderkey""")

cte("s_orders", """
SELECT ROW_NUMBER() OVER (ORDER BY order_id) AS order_sk, b.* EXCLUDE (employee_id),
       COALESCE(customer_id IS NOT NULL AND ROW_NUMBER() OVER (PARTITION BY customer_id ORDER BY order_timestamp, order_id) = 1, FALSE) AS is_first_order
FROM s_orders_base b""")

cte("s_employee_links", """
SELECT employee_id, order_id, order_date FROM s_orders_base WHERE employee_id IS NOT NULL""")

cte("s_lines", """
SELECT * FROM (
  SELECT l.*, ROW_NUMBER() OVER (PARTITION BY l_orderkey, l_linenumber
        ORDER BY CAST(l_shipdate AS DATE) DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC,
                 l_extendedprice DESC, CAST(l_discount AS DECIMAL(18,2)) DESC, CAST(l_tax AS DECIMAL(18,2)) DESC) AS rn
  FROM lineitem l) WHERE rn = 1""")

cte("s_order_items", """
SELECT ROW_NUMBER() OVER (ORDER BY CAST(l.l_orderkey AS VARCHAR), CAST(l.l_linenumber AS VARCHAR)) AS order_item_sk,
       CAST(l.l_orderkey AS VARCHAR) AS order_id, CAST(l.l_linenumber AS VARCHAR) AS item_id,
       CAST(l.l_partkey AS VARCHAR) AS product_id, CAST(l.l_quantity AS BIGINT) AS quantity,
       CAST(p.p_retailprice AS DECIMAL(18,4)) AS unit_price,
       CAST(CAST(l.l_extendedprice AS DECIMAL(18,2)) * CAST(l.l_discount AS DECIMAL(18,2)) AS DECIMAL(18,4)) AS discount_amount,
       CAST(CAST(l.l_extendedprice AS DECIMAL(18,2)) * CAST(l.l_tax AS DECIMAL(18,2)) AS DECIMAL(18,4)) AS tax_amount,
       CAST(l.l_extendedprice AS DECIMAL(18,4)) AS line_total,
       l.l_returnflag = 'R' AS return_flag
FROM s_lines l LEFT JOIN part p ON l.l_partkey = p.p_partkey""")

cte("s_products", f"""
SELECT ROW_NUMBER() OVER (ORDER BY CAST(p_partkey AS VARCHAR)) AS product_sk,
       CAST(p_partkey AS VARCHAR) AS product_id, 'SKU-' || CAST(p_partkey AS VARCHAR) AS sku,
       trim(p_name) AS product_name, 'C-' || p_type || '-' || p_brand AS category_id,
       CAST(p_partkey % 100 AS VARCHAR) AS supplier_id, p_brand AS brand,
       CAST(CAST(p_retailprice AS DECIMAL(18,2)) * CAST(0.6 AS DECIMAL(2,1)) AS DECIMAL(18,4)) AS unit_cost,
       CAST(p_retailprice AS DECIMAL(18,4)) AS unit_price,
       CAST(p_size * 0.25 AS DECIMAL(10,4)) AS weight_kg,
       COALESCE(CASE WHEN p_partkey % 13 <> 0 THEN p_size % 10 <> 0 END, TRUE) AS is_active,
       FALSE AS is_digital,
       {RUN1} AS effective_from, {EOT} AS effective_to, TRUE AS is_current
FROM part""")

cte("s_categories", """
SELECT ROW_NUMBER() OVER (ORDER BY category_id) AS category_sk, * FROM (
  SELECT DISTINCT 'C-' || p_type AS category_id, p_type AS category_name, CAST(NULL AS VARCHAR) AS parent_category_id,
         CAST(1 AS BIGINT) AS category_level, p_type AS category_path, TRUE AS is_active FROM part
  UNION ALL
  SELECT DISTINCT 'C-' || p_type || '-' || p_brand, p_brand, 'C-' || p_type, CAST(2 AS BIGINT),
         p_type || ' > ' || p_brand, TRUE FROM part)""")

cte("s_suppliers", """
SELECT ROW_NUMBER() OVER (ORDER BY CAST(s.s_suppkey AS VARCHAR)) AS supplier_sk,
       CAST(s.s_suppkey AS VARCHAR) AS supplier_id, trim(s.s_name) AS supplier_name,
       'Contact ' || CAST(s.s_suppkey AS VARCHAR) AS contact_name,
       lower(trim(' Sup' || CAST(s.s_suppkey AS VARCHAR) || '@Vendor.COM')) AS email,
       regexp_replace('+1-800-' || CAST(s.s_suppkey AS VARCHAR), '[^0-9+]', '', 'g') AS phone,
       n.n_name AS country, r.r_name AS region,
       CAST(30 + (s.s_suppkey % 3) * 15 AS BIGINT) AS payment_terms_days,
       CAST(5 + s.s_suppkey % 20 AS BIGINT) AS lead_time_days,
       COALESCE(s.s_acctbal > 0, TRUE) AS is_active,
       CAST(CAST(s.s_suppkey % 51 AS DECIMAL(10,1)) / 10 AS DECIMAL(3,1)) AS supplier_rating
FROM supplier s LEFT JOIN nation n ON s.s_nationkey = n.n_nationkey
LEFT JOIN region r ON n.n_regionkey = r.r_regionkey""")

cte("s_stores", """
SELECT ROW_NUMBER() OVER (ORDER BY 'S' || CAST(n.n_nationkey AS VARCHAR)) AS store_sk,
       'S' || CAST(n.n_nationkey AS VARCHAR) AS store_id, trim(n.n_name) AS store_name,
       CASE n.n_nationkey % 3 WHEN 0 THEN 'FLAGSHIP' WHEN 1 THEN 'OUTLET' ELSE 'STANDARD' END AS store_type,
       CAST(n.n_nationkey AS VARCHAR) || ' Main St' AS address_line1, n.n_name AS city, r.r_name AS state_province,
       CAST(n.n_nationkey + 10000 AS VARCHAR) AS postal_code, upper(substr(r.r_name, 1, 2)) AS country_code,
       CAST(n.n_nationkey * 1.5 AS DOUBLE) AS latitude, CAST(n.n_nationkey * -2.25 AS DOUBLE) AS longitude,
       'UTC' AS timezone, DATE '1990-01-01' + CAST(n.n_nationkey * 100 AS INTEGER) AS opening_date,
       CAST(NULL AS DATE) AS closing_date, TRUE AS is_active, 'E' || CAST(n.n_nationkey AS VARCHAR) AS store_manager_id,
       CAST(n.n_nationkey * 500 + 1000 + c.cnt % 1000 AS BIGINT) AS square_footage
FROM (SELECT c_nationkey, COUNT(*) AS cnt FROM customer GROUP BY c_nationkey) c
JOIN nation n ON c.c_nationkey = n.n_nationkey LEFT JOIN region r ON n.n_regionkey = r.r_regionkey""")

cte("s_customers_v1", f"""
SELECT ROW_NUMBER() OVER (ORDER BY CAST(c_custkey AS VARCHAR)) AS customer_sk,
       CAST(c_custkey AS VARCHAR) AS customer_id, trim(c_mktsegment) AS first_name, trim(c_name) AS last_name,
       trim(c_mktsegment) || ' ' || trim(c_name) AS full_name,
       'user' || CAST(c_custkey AS VARCHAR) || '@shop.com' AS email,
       '55501' || CAST(c_custkey AS VARCHAR) AS phone,
       CASE WHEN c_custkey % 10 <> 0 THEN DATE '1950-01-01' + CAST((c_custkey * 37) % 18000 AS INTEGER) END AS date_of_birth,
       CASE c_custkey % 3 WHEN 0 THEN 'M' WHEN 1 THEN 'F' END AS gender,
       CASE WHEN c_acctbal >= 7500 THEN 'PLATINUM' WHEN c_acctbal >= 5000 THEN 'GOLD'
            WHEN c_acctbal >= 2500 THEN 'SILVER' ELSE 'BRONZE' END AS customer_tier,
       DATE '1994-01-01' + CAST(c_custkey % 2500 AS INTEGER) AS registration_date,
       c_acctbal >= 0 AS is_active,
       c_custkey % 7 = 3 AS changed
FROM customer""")

cte("s_customers", f"""
SELECT customer_sk, customer_id, first_name, last_name, full_name, email, phone, date_of_birth, gender,
       customer_tier, registration_date, is_active,
       {RUN1} AS effective_from, CASE WHEN changed THEN {RUN2} ELSE {EOT} END AS effective_to,
       NOT changed AS is_current
FROM s_customers_v1
UNION ALL
SELECT (SELECT COUNT(*) FROM s_customers_v1) + ROW_NUMBER() OVER (ORDER BY customer_id), customer_id, first_name,
       last_name, full_name, 'user' || customer_id || '@new.example', phone, date_of_birth, gender, customer_tier,
       registration_date, is_active, {RUN2}, {EOT}, TRUE
FROM s_customers_v1 WHERE changed""")

cte("s_returns", """
SELECT ROW_NUMBER() OVER (ORDER BY return_id) AS return_sk, * FROM (
SELECT 'RT' || CAST(l.l_orderkey AS VARCHAR) || '-' || CAST(l.l_linenumber AS VARCHAR) AS return_id,
       CAST(l.l_orderkey AS VARCHAR) AS order_id, CAST(o.o_custkey AS VARCHAR) AS customer_id,
       CAST(l.l_shipdate AS DATE) + 7 AS return_date,
       CASE l.l_partkey % 5 WHEN 0 THEN 'DEFECTIVE' WHEN 1 THEN 'WRONG_ITEM' WHEN 2 THEN 'NOT_AS_DESCRIBED'
            WHEN 3 THEN 'CHANGED_MIND' ELSE 'OTHER' END AS return_reason,
       CASE l.l_orderkey % 3 WHEN 0 THEN 'REFUNDED' WHEN 1 THEN 'APPROVED' ELSE 'RECEIVED' END AS return_status,
       CAST(l.l_extendedprice AS DECIMAL(18,2)) AS refund_amount,
       CASE l.l_linenumber % 3 WHEN 0 THEN 'ORIGINAL_PAYMENT' WHEN 1 THEN 'STORE_CREDIT' ELSE 'GIFT_CARD' END AS refund_method,
       CAST(l.l_quantity AS BIGINT) AS items_count
FROM s_lines l LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey
WHERE l.l_returnflag = 'R')""")

cte("s_reviews", """
SELECT ROW_NUMBER() OVER (ORDER BY review_id) AS review_sk, * FROM (
SELECT 'RV' || CAST(l.l_orderkey AS VARCHAR) || '-' || CAST(l.l_linenumber AS VARCHAR) AS review_id,
       CAST(l.l_partkey AS VARCHAR) AS product_id, CAST(o.o_custkey AS VARCHAR) AS customer_id,
       CAST(l.l_orderkey AS VARCHAR) AS order_id,
       CAST(CAST(CAST(l.l_quantity AS BIGINT) % 6 AS DOUBLE) AS DECIMAL(2,1)) AS rating,
       'Review' AS review_title, 'Body' AS review_body,
       CAST(l.l_shipdate AS DATE) + 14 AS review_date,
       l.l_returnflag <> 'R' AS is_verified_purchase,
       l.l_orderkey % 50 = 0 AS is_flagged,
       CAST(CASE WHEN l.l_linenumber <> 1 THEN l.l_linenumber % 3 ELSE 0 END AS BIGINT) AS helpful_votes
FROM s_lines l LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey
WHERE l.l_partkey % 4 = 0 AND CAST(l.l_quantity AS BIGINT) % 6 BETWEEN 1 AND 5)""")

cte("s_shipments_base", """
SELECT l.l_orderkey, MIN(CAST(l.l_shipdate AS DATE)) AS ship,
       MAX(CASE WHEN l.l_linestatus = 'O' THEN 1 ELSE 0 END) AS open_, SUM(CAST(l.l_quantity AS BIGINT)) AS qty
FROM s_lines l GROUP BY l.l_orderkey""")

cte("s_shipments", """
SELECT ROW_NUMBER() OVER (ORDER BY shipment_id) AS shipment_sk, *,
       COALESCE(actual_delivery > estimated_delivery, FALSE) AS is_late,
       CAST(datediff('day', ship_date, actual_delivery) AS BIGINT) AS days_to_deliver FROM (
SELECT 'SH' || CAST(b.l_orderkey AS VARCHAR) AS shipment_id, CAST(b.l_orderkey AS VARCHAR) AS order_id,
       CAST(o.o_custkey AS VARCHAR) AS customer_id,
       CASE b.l_orderkey % 5 WHEN 0 THEN 'FEDEX' WHEN 1 THEN 'UPS' WHEN 2 THEN 'DHL' WHEN 3 THEN 'USPS' ELSE 'LOCAL' END AS carrier,
       'TRK' || CAST(b.l_orderkey AS VARCHAR) AS tracking_number,
       b.ship AS ship_date, b.ship + 5 AS estimated_delivery,
       CASE WHEN b.open_ = 0 THEN b.ship + CAST(b.l_orderkey % 10 AS INTEGER) END AS actual_delivery,
       CASE WHEN b.open_ = 0 THEN 'DELIVERED' ELSE 'IN_TRANSIT' END AS shipment_status,
       CASE b.l_orderkey % 4 WHEN 0 THEN 'STANDARD' WHEN 1 THEN 'EXPRESS' WHEN 2 THEN 'OVERNIGHT' ELSE 'SAME_DAY' END AS shipping_method,
       '10001' AS origin_zip, CAST(o.o_custkey % 89999 + 10000 AS VARCHAR) AS destination_zip,
       CASE c.c_nationkey % 4 WHEN 0 THEN 'US' WHEN 1 THEN 'CA' WHEN 2 THEN 'GB' ELSE 'DE' END AS destination_country,
       CAST(b.qty * 0.5 AS DECIMAL(10,4)) AS weight_kg,
       CAST(5 + b.l_orderkey % 20 AS DECIMAL(18,2)) AS shipping_cost
FROM s_shipments_base b LEFT JOIN orders o ON b.l_orderkey = o.o_orderkey
LEFT JOIN customer c ON o.o_custkey = c.c_custkey)""")

cte("s_payments", """
SELECT ROW_NUMBER() OVER (ORDER BY payment_id) AS payment_sk, * FROM (
SELECT 'PAY' || CAST(o.o_orderkey AS VARCHAR) AS payment_id, CAST(o.o_orderkey AS VARCHAR) AS order_id,
       CAST(o.o_custkey AS VARCHAR) AS customer_id,
       CASE o.o_orderkey % 5 WHEN 0 THEN 'CREDIT_CARD' WHEN 1 THEN 'DEBIT_CARD' WHEN 2 THEN 'PAYPAL'
            WHEN 3 THEN 'APPLE_PAY' ELSE 'BANK_TRANSFER' END AS payment_method,
       'CAPTURED' AS payment_status, t.total AS amount, 'USD' AS currency_code,
       o.o_orderdate + to_seconds(CAST(o.o_orderkey % 86400 AS BIGINT)) + INTERVAL 1 HOUR AS payment_timestamp,
       'GW' || CAST(o.o_orderkey AS VARCHAR) AS gateway_reference, FALSE AS is_refund,
       CAST(NULL AS VARCHAR) AS original_payment_id
FROM orders o LEFT JOIN o_totals t ON o.o_orderkey = t.o_orderkey
UNION ALL
SELECT 'REF' || CAST(o.o_orderkey AS VARCHAR), CAST(o.o_orderkey AS VARCHAR), CAST(o.o_custkey AS VARCHAR),
       CASE o.o_orderkey % 5 WHEN 0 THEN 'CREDIT_CARD' WHEN 1 THEN 'DEBIT_CARD' WHEN 2 THEN 'PAYPAL'
            WHEN 3 THEN 'APPLE_PAY' ELSE 'BANK_TRANSFER' END,
       'REFUNDED', t.total, 'USD',
       o.o_orderdate + to_seconds(CAST(o.o_orderkey % 86400 AS BIGINT)) + INTERVAL 10 DAY,
       'GW' || CAST(o.o_orderkey AS VARCHAR) || 'R', TRUE, 'PAY' || CAST(o.o_orderkey AS VARCHAR)
FROM orders o LEFT JOIN o_totals t ON o.o_orderkey = t.o_orderkey WHERE o.o_orderkey % 20 = 1)""")

cte("s_loyalty_points", """
SELECT ROW_NUMBER() OVER (ORDER BY transaction_id) AS loyalty_sk, * FROM (
SELECT 'LE' || CAST(o.o_orderkey AS VARCHAR) AS transaction_id, CAST(o.o_custkey AS VARCHAR) AS customer_id,
       CAST(o.o_orderkey AS VARCHAR) AS order_id, 'EARN' AS transaction_type,
       CAST(floor(t.total / 100) AS BIGINT) AS points_change, CAST(NULL AS BIGINT) AS points_balance_after,
       CAST(o.o_orderdate AS DATE) AS transaction_date,
       CAST(CAST(o.o_orderdate AS DATE) AS TIMESTAMP) + INTERVAL 12 HOUR AS transaction_timestamp,
       CAST(o.o_orderdate AS DATE) + 365 AS expiry_date, 'ORD' || CAST(o.o_orderkey AS VARCHAR) AS reference_code,
       CAST(NULL AS VARCHAR) AS notes
FROM orders o LEFT JOIN o_totals t ON o.o_orderkey = t.o_orderkey
UNION ALL
SELECT 'LR' || CAST(o.o_orderkey AS VARCHAR), CAST(o.o_custkey AS VARCHAR), CAST(o.o_orderkey AS VARCHAR), 'REDEEM',
       CAST(-floor(t.total / 200) AS BIGINT), NULL, CAST(o.o_orderdate AS DATE) + 3,
       CAST(CAST(o.o_orderdate AS DATE) + 3 AS TIMESTAMP) + INTERVAL 12 HOUR, NULL,
       'ORD' || CAST(o.o_orderkey AS VARCHAR), NULL
FROM orders o LEFT JOIN o_totals t ON o.o_orderkey = t.o_orderkey WHERE o.o_orderkey % 5 = 0
UNION ALL
SELECT 'LX' || CAST(o.o_orderkey AS VARCHAR), CAST(o.o_custkey AS VARCHAR), CAST(o.o_orderkey AS VARCHAR), 'EXPIRE',
       CAST(-10 AS BIGINT), NULL, CAST(o.o_orderdate AS DATE) + 365,
       CAST(CAST(o.o_orderdate AS DATE) + 365 AS TIMESTAMP) + INTERVAL 12 HOUR, NULL,
       'ORD' || CAST(o.o_orderkey AS VARCHAR), NULL
FROM orders o WHERE o.o_orderkey % 17 = 0)""")

cte("s_inventory", """
SELECT ROW_NUMBER() OVER (ORDER BY product_id, location_id, snapshot_timestamp) AS inventory_sk, * FROM (
SELECT CAST(p.p_partkey AS VARCHAR) AS product_id, CASE WHEN g.loc = 0 THEN 'WH-1' ELSE 'ST-1' END AS location_id,
       CASE WHEN g.loc = 1 THEN 'STORE' ELSE 'WAREHOUSE' END AS location_type,
       CAST((p.p_partkey * 7 + g.loc * 11 + g.day * 3) % 150 AS BIGINT) AS quantity_on_hand,
       CAST(CASE WHEN p.p_partkey % 9 <> 0 THEN p.p_partkey % 10 ELSE 0 END AS BIGINT) AS quantity_reserved,
       CAST((p.p_partkey * 7 + g.loc * 11 + g.day * 3) % 150 - CASE WHEN p.p_partkey % 9 <> 0 THEN p.p_partkey % 10 ELSE 0 END AS BIGINT) AS quantity_available,
       CAST(20 AS BIGINT) AS reorder_point, CAST(100 AS BIGINT) AS reorder_quantity,
       DATE '2001-07-30' + g.day AS snapshot_date,
       CAST(DATE '2001-07-30' + g.day AS TIMESTAMP) + INTERVAL 6 HOUR AS snapshot_timestamp
FROM part p CROSS JOIN (SELECT * FROM (VALUES (0,0),(0,1),(0,2),(1,0),(1,1),(1,2)) v(loc, day)) g)""")

cte("s_purchase_orders", """
SELECT 'PO-' || CAST(l_suppkey AS VARCHAR) || '-' || CAST(l_partkey AS VARCHAR) AS po_number,
       CAST(l_suppkey AS VARCHAR) AS supplier_id, CAST(l_partkey AS VARCHAR) AS product_id,
       MIN(CAST(l_shipdate AS DATE)) AS order_date, MIN(CAST(l_shipdate AS DATE)) + 14 AS expected_delivery,
       MIN(CAST(l_shipdate AS DATE)) + CAST(l_suppkey % 21 AS INTEGER) AS actual_delivery,
       CAST(SUM(CAST(l_quantity AS BIGINT)) AS BIGINT) AS quantity_ordered,
       CAST(SUM(CAST(l_quantity AS BIGINT)) - l_partkey % 3 AS BIGINT) AS quantity_received,
       CAST(10 + l_suppkey % 7 AS DOUBLE) AS unit_cost,
       CAST(CAST(10 + l_suppkey % 7 AS DECIMAL(18,2)) * SUM(CAST(l_quantity AS BIGINT)) AS DOUBLE) AS total_cost,
       'RECEIVED' AS po_status
FROM lineitem GROUP BY l_suppkey, l_partkey""")

cte("ev_sessions", """
SELECT *, 'U' || CAST(user_id AS VARCHAR) || '-' || CAST(SUM(new_) OVER (PARTITION BY user_id ORDER BY ts, event_id
             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS VARCHAR) AS session_id
FROM (SELECT e.*, CASE WHEN LAG(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) IS NULL
                        OR ts > LAG(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) + INTERVAL 30 MINUTE
                       THEN 1 ELSE 0 END AS new_
      FROM events e)""")

cte("s_web_sessions", """
SELECT ROW_NUMBER() OVER (ORDER BY session_id) AS session_sk, * FROM (
SELECT session_id, CAST(user_id AS VARCHAR) AS customer_id,
       CASE user_id % 3 WHEN 0 THEN 'DESKTOP' WHEN 1 THEN 'MOBILE' ELSE 'TABLET' END AS device_type,
       CASE WHEN user_id % 2 = 0 THEN 'chrome' ELSE 'firefox' END AS browser, 'linux' AS os,
       CASE user_id % 6 WHEN 0 THEN 'ORGANIC' WHEN 1 THEN 'PAID' WHEN 2 THEN 'EMAIL' WHEN 4 THEN 'REFERRAL'
            WHEN 5 THEN 'SOCIAL' ELSE 'DIRECT' END AS channel,
       CASE WHEN user_id % 6 IN (1, 2) THEN 'CMP' || CAST(user_id % 10 AS VARCHAR) END AS campaign_id,
       MIN(ts) AS session_start, MAX(ts) AS session_end,
       CAST(epoch(date_trunc('second', MAX(ts))) - epoch(date_trunc('second', MIN(ts))) AS BIGINT) AS session_duration_sec,
       CAST(CASE WHEN SUM(CASE WHEN event_type = 'view' THEN 1 ELSE 0 END) > 0
                 THEN SUM(CASE WHEN event_type = 'view' THEN 1 ELSE 0 END) ELSE 1 END AS BIGINT) AS page_views,
       COUNT(*) = 1 AS is_bounce, MAX(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) = 1 AS converted,
       CAST(NULL AS VARCHAR) AS order_id, '/home' AS landing_page
FROM ev_sessions GROUP BY session_id, user_id)""")

cte("raw_cart_events", """
SELECT session_id AS src_session_id, CAST(user_id AS VARCHAR) AS src_customer_id,
       CASE event_type WHEN 'click' THEN 'add_to_cart' WHEN 'error' THEN 'remove_from_cart'
            WHEN 'view' THEN 'checkout_started' ELSE event_type END AS event_type,
       ts AS load_timestamp
FROM ev_sessions""")

cte("s_campaigns", """
SELECT ROW_NUMBER() OVER (ORDER BY campaign_id) AS campaign_sk, * FROM (
SELECT 'CMP' || CAST(c AS VARCHAR) AS campaign_id, 'Campaign ' || CAST(c AS VARCHAR) AS campaign_name,
       CASE c % 6 WHEN 0 THEN 'EMAIL' WHEN 1 THEN 'SMS' WHEN 2 THEN 'SOCIAL' WHEN 3 THEN 'DISPLAY' WHEN 4 THEN 'SEARCH'
            ELSE 'AFFILIATE' END AS campaign_type,
       CASE WHEN c % 2 = 0 THEN 'PAID' ELSE 'EMAIL' END AS channel,
       s AS start_date, e AS end_date, CAST(spend * 2 AS DECIMAL(18,2)) AS budget_amount,
       CAST(spend AS DECIMAL(18,2)) AS spend_amount, 'ALL' AS target_audience,
       CAST(imp AS BIGINT) AS impressions, CAST(clk AS BIGINT) AS clicks, CAST(conv AS BIGINT) AS conversions,
       CAST(COALESCE(rev, 0) * 3 AS DECIMAL(18,2)) AS revenue_attributed, TRUE AS is_active
FROM (SELECT user_id % 10 AS c, COUNT(*) AS imp, SUM(CASE WHEN event_type = 'click' THEN 1 ELSE 0 END) AS clk,
             SUM(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) AS conv,
             SUM(CAST(value AS DECIMAL(18,2))) AS spend,
             SUM(CASE WHEN event_type = 'purchase' THEN CAST(value AS DECIMAL(18,2)) END) AS rev,
             MIN(CAST(ts AS DATE)) AS s, MAX(CAST(ts AS DATE)) AS e
      FROM events WHERE user_id % 6 IN (1, 2) GROUP BY user_id % 10))""")

cte("s_promotions", """
SELECT ROW_NUMBER() OVER (ORDER BY promotion_id) AS promotion_sk, * FROM (
SELECT 'P' || CAST(i AS VARCHAR) AS promotion_id, 'Promo ' || CAST(i AS VARCHAR) AS promotion_name,
       CASE i % 4 WHEN 0 THEN 'PERCENTAGE_OFF' WHEN 1 THEN 'FIXED_AMOUNT' WHEN 2 THEN 'BUY_X_GET_Y'
            ELSE 'FREE_SHIPPING' END AS promotion_type,
       CAST(i * 2.5 + 5 AS DECIMAL(10,4)) AS discount_value, CAST(50 AS DECIMAL(18,2)) AS min_order_amount,
       CAST(100 AS DECIMAL(18,2)) AS max_discount_amount, s AS start_date, e AS end_date,
       CASE WHEN i % 2 = 1 THEN 'CATEGORY' ELSE 'ALL' END AS applies_to, 'SAVE' || CAST(i AS VARCHAR) AS promo_code,
       i % 2 = 0 AS is_stackable, TRUE AS is_active,
       CAST(CASE WHEN i <> 7 THEN n * 2 END AS BIGINT) AS usage_limit, CAST(n AS BIGINT) AS times_used
FROM (SELECT o_orderkey % 8 AS i, MIN(CAST(o_orderdate AS DATE)) AS s, MAX(CAST(o_orderdate AS DATE)) AS e,
             COUNT(*) AS n FROM orders WHERE o_orderkey % 3 = 0 GROUP BY o_orderkey % 8))""")

cte("s_employees", f"""
SELECT ROW_NUMBER() OVER (ORDER BY employee_id) AS employee_sk, * FROM (
SELECT 'E' || CAST(i AS VARCHAR) AS employee_id, 'Emp' AS first_name, CAST(i AS VARCHAR) AS last_name,
       'Emp ' || CAST(i AS VARCHAR) AS full_name,
       CASE i % 4 WHEN 0 THEN 'associate' WHEN 1 THEN 'senior associate' WHEN 2 THEN 'supervisor'
            ELSE 'store manager' END AS job_title,
       'SALES' AS department, 'S' || CAST(i % 25 AS VARCHAR) AS store_id,
       CASE WHEN i >= 5 THEN 'E' || CAST(i % 5 AS VARCHAR) END AS manager_id,
       s - 30 AS hire_date, CASE WHEN i % 13 = 0 THEN e + 30 END AS termination_date,
       CASE WHEN i % 13 = 0 THEN 'TERMINATED' ELSE 'ACTIVE' END AS employment_status,
       CASE i % 3 WHEN 1 THEN 'PART_TIME' ELSE 'FULL_TIME' END AS employment_type,
       {RUN1} AS effective_from, {EOT} AS effective_to, TRUE AS is_current
FROM (SELECT o_custkey % 40 AS i, MIN(CAST(o_orderdate AS DATE)) AS s, MAX(CAST(o_orderdate AS DATE)) AS e
      FROM orders WHERE substr(o_orderpriority, 1, 1) = '3' GROUP BY o_custkey % 40))""")

cte("s_addresses", f"""
SELECT ROW_NUMBER() OVER (ORDER BY address_id) AS address_sk, * FROM (
SELECT 'A' || CAST(c_custkey AS VARCHAR) AS address_id, CAST(c_custkey AS VARCHAR) AS customer_id,
       CASE c_custkey % 3 WHEN 0 THEN 'BILLING' ELSE 'SHIPPING' END AS address_type,
       CAST(c_custkey AS VARCHAR) || ' Elm St' AS address_line1, CAST(NULL AS VARCHAR) AS address_line2,
       'City ' || CAST(c_custkey % 37 AS VARCHAR) AS city, 'ST' || CAST(c_nationkey AS VARCHAR) AS state_province,
       CAST(c_custkey % 89999 + 10000 AS VARCHAR) AS postal_code,
       CASE c_nationkey % 4 WHEN 0 THEN 'US' WHEN 1 THEN 'CA' WHEN 2 THEN 'GB' ELSE 'DE' END AS country_code,
       TRUE AS is_default, c_custkey % 2 = 0 AS is_validated,
       CAST(c_nationkey * 1.5 AS DOUBLE) AS latitude, CAST(c_nationkey * -2.5 AS DOUBLE) AS longitude,
       {RUN1} AS effective_from, {EOT} AS effective_to, TRUE AS is_current
FROM customer
UNION ALL
SELECT 'A' || CAST(c_custkey AS VARCHAR) || '-2', CAST(c_custkey AS VARCHAR), 'BILLING',
       CAST(c_custkey AS VARCHAR) || ' Elm St', NULL, 'City ' || CAST((c_custkey + 1) % 37 AS VARCHAR),
       'ST' || CAST(c_nationkey AS VARCHAR), CAST(c_custkey % 89999 + 10000 AS VARCHAR),
       CASE c_nationkey % 4 WHEN 0 THEN 'US' WHEN 1 THEN 'CA' WHEN 2 THEN 'GB' ELSE 'DE' END,
       FALSE, c_custkey % 2 = 0, CAST(c_nationkey * 1.5 AS DOUBLE), CAST(c_nationkey * -2.5 AS DOUBLE),
       {RUN1}, {EOT}, TRUE
FROM customer WHERE c_custkey % 5 = 0)""")

cte("s_product_catalog", """
SELECT p.product_sk, p.product_id, p.sku, p.product_name, p.brand, c.category_id, c.category_name,
       c.parent_category_id, pc.category_name AS parent_category_name,
       split_part(c.category_path, ' > ', 1) AS top_category_name, c.category_path,
       s.supplier_id, s.supplier_name, p.unit_cost, p.unit_price,
       CAST(CASE WHEN p.unit_price > 0 THEN (CAST(p.unit_price AS DOUBLE) - CAST(p.unit_cost AS DOUBLE))
                 / CAST(p.unit_price AS DOUBLE) * 100 END AS DECIMAL(8,4)) AS margin_pct,
       p.is_active, p.is_digital, p.weight_kg
FROM s_products p LEFT JOIN s_categories c ON p.category_id = c.category_id
LEFT JOIN s_categories pc ON c.parent_category_id = pc.category_id
LEFT JOIN s_suppliers s ON p.supplier_id = s.supplier_id
WHERE p.is_current""")


def with_ctes(sql: str, extra: dict[str, str] | None = None) -> str:
    """Prefix ``sql`` with the CTEs it references (dependencies first)."""
    pool = dict(CTES)
    pool.update(extra or {})
    order: list[str] = []

    def visit(text: str) -> None:
        for name in pool:
            if name not in order and re.search(rf"\b{name}\b", text):
                visit(pool[name])
                if name not in order:
                    order.append(name)

    visit(sql)
    if not order:
        return sql
    return "WITH " + ",\n".join(f"{n} AS ({pool[n]})" for n in order) + "\n" + sql
