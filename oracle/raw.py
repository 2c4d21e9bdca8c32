"""Oracle SQL of the raw feeds (lifted keys, lineage, load stamp, batch id) and of the alert text."""

from __future__ import annotations

from oracle.bind import RUN1, RUN2, SRUN, cte


def feed(name: str, keys: str, rows: str, load: str = RUN1, batch: str = "'b1'") -> None:
    cte(f"m_raw_{name}", f"""
SELECT {keys}, 'testdata/{name}' AS file_name, CAST(NULL AS BIGINT) AS file_row_number, {load} AS load_timestamp,
       CAST({batch} AS VARCHAR) AS batch_id
FROM {rows}""")


def text(column: str) -> str:
    return f"CAST({column} AS VARCHAR)"


ORDER = f"{text('o_orderkey')} AS src_order_id"
LINE = f"{text('l_orderkey')} || '-' || {text('l_linenumber')}"
ONE_LINE = "(SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)"

cte("m_raw_customers", f"""
SELECT {text('c_custkey')} AS src_customer_id, 'testdata/customers' AS file_name, CAST(NULL AS BIGINT) AS file_row_number, stamp AS load_timestamp, batch AS batch_id
FROM customer, (VALUES ({RUN1}, 'b1'), ({RUN2}, 'b2')) AS loads(stamp, batch) WHERE batch = 'b1' OR c_custkey % 7 = 3""")
feed("order_items", f"{text('l_orderkey')} AS src_order_id, {text('l_linenumber')} AS src_item_id", "lineitem")
feed("products", f"{text('p_partkey')} AS src_product_id", "part")
feed("categories", "id AS src_category_id", "(SELECT DISTINCT 'C-' || p_type AS id FROM part UNION ALL SELECT DISTINCT 'C-' || p_type || '-' || p_brand FROM part)")
feed("suppliers", f"{text('s_suppkey')} AS src_supplier_id", "supplier")
feed("inventory", "product AS src_product_id, place AS src_location_id", f"""(
    SELECT {text('p_partkey')} AS product, place FROM part, (VALUES ('WH-1'), ('ST-1')) AS p(place), range(3)
    UNION ALL SELECT {text('l_partkey')}, NULL FROM (SELECT DISTINCT l_suppkey, l_partkey FROM lineitem))""")
feed("payments", f"kind || {text('o_orderkey')} AS src_payment_id, {ORDER}", "orders, (VALUES ('PAY'), ('REF')) AS k(kind) WHERE kind = 'PAY' OR o_orderkey % 20 = 1", batch="NULL")
feed("returns", "return_id AS src_return_id, order_id AS src_order_id", "s_returns")
feed("reviews", "'RV' || id AS src_review_id, product AS src_product_id", f"""(
    SELECT {LINE} AS id, {text('l_partkey')} AS product
    FROM (SELECT l_orderkey, l_linenumber, l_partkey, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
            ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC, l_extendedprice DESC, l_discount DESC, l_tax DESC) AS nth FROM lineitem)
    WHERE nth = 1 AND l_partkey % 4 = 0)""")
feed("employees", f"'E' || {text('k')} AS src_employee_id", "(SELECT DISTINCT o_custkey % 40 AS k FROM orders WHERE substr(o_orderpriority, 1, 1) = '3')")
feed("stores", f"'S' || {text('c_nationkey')} AS src_store_id", "(SELECT DISTINCT c_nationkey FROM customer WHERE c_nationkey IN (SELECT n_nationkey FROM nation))")
feed("promotions", f"'P' || {text('k')} AS src_promotion_id", "(SELECT DISTINCT o_orderkey % 8 AS k FROM orders WHERE o_orderkey % 3 = 0)")
feed("campaigns", f"'CMP' || {text('k')} AS src_campaign_id", "(SELECT DISTINCT user_id % 10 AS k FROM events WHERE user_id % 6 IN (1, 2))", SRUN)
feed("web_sessions", "session_id AS src_session_id", "(SELECT DISTINCT session_id FROM ev_sessions)", SRUN, "NULL")
feed("page_views", "session_id AS src_session_id, '/p/' || json_extract_string(props, '$.k') AS src_page_url", "ev_sessions WHERE event_type = 'view'", "ts", "NULL")
feed("shipments", f"'SH' || {text('l_orderkey')} AS src_shipment_id, {text('l_orderkey')} AS src_order_id", "(SELECT DISTINCT l_orderkey FROM lineitem)")
feed("addresses", f"'A' || {text('c_custkey')} || suffix AS src_address_id, {text('c_custkey')} AS src_customer_id", "customer, (VALUES (''), ('-2')) AS s(suffix) WHERE suffix = '' OR c_custkey % 5 = 0")
feed("loyalty_points", f"kind || {text('o_orderkey')} AS src_transaction_id, {text('o_custkey')} AS src_customer_id",
     "orders, (VALUES ('LE', 1), ('LR', 5), ('LX', 17)) AS k(kind, every) WHERE o_orderkey % every = 0")

cte("m_landing_json_orders", f"SELECT {ORDER}, TRUE AS numbers_whole FROM orders")
cte("m_landing_csv_stores", "SELECT src_store_id, TRUE AS numbers_whole FROM m_raw_stores")
cte("m_landing_parquet_suppliers", "SELECT src_supplier_id, TRUE AS numbers_whole FROM m_raw_suppliers")


def rounded(x: str, places: int) -> str:
    """Half up on the number's shortest decimal text, as the alert prints it."""
    return f"CAST(CAST(ROUND(CAST(CAST({x} AS VARCHAR) AS DECIMAL(38,18)), {places}) AS DECIMAL(38,{places})) AS VARCHAR)"


_BULLET = "chr(10) || '  • ' || "
cte("m_grid_alert_text", f"""
SELECT node_id, timestamp, severity,
       'Grid Alert — Severity: ' || severity || chr(10) || 'Node     : ' || node_id || chr(10) || 'Timestamp: ' || replace(CAST(timestamp AS VARCHAR), ' ', 'T')
       || chr(10) || 'Voltage  : ' || {rounded('voltage_kv', 2)} || ' kV' || chr(10) || 'Load     : ' || {rounded('load_pct', 1)} || '%'
       || chr(10) || 'Frequency: ' || {rounded('frequency_hz', 3)} || ' Hz' || chr(10) || chr(10) || 'Issues detected:'
       || CASE WHEN vpct > 5.0 THEN {_BULLET}'Voltage deviation ' || {rounded('abs(voltage_kv - nominal_voltage_kv)', 2)} || ' kV exceeds 5.0% threshold' ELSE '' END
       || CASE WHEN load_pct > 90.0 THEN {_BULLET}'Load ' || {rounded('load_pct', 1)} || '% exceeds capacity threshold 90.0%' ELSE '' END
       || CASE WHEN fdev > 0.5 THEN {_BULLET}'Frequency deviation ' || {rounded('fdev', 3)} || ' Hz exceeds 0.500 Hz threshold' ELSE '' END AS message
FROM (SELECT *, CASE WHEN load_pct >= 98.0 OR n_issues >= 3 THEN 'CRITICAL' WHEN load_pct >= 90.0 OR n_issues >= 2 THEN 'HIGH' ELSE 'MEDIUM' END AS severity FROM t_eval)
WHERE n_issues > 0""")
