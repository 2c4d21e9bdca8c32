"""Oracle SQL of second loads: the rows of the whole feed, surrogate keys dealt load by load."""

from __future__ import annotations

from oracle.bind import AS_OF, CTES, cte

cte("m_inventory_second_load", """
SELECT * REPLACE (ROW_NUMBER() OVER (ORDER BY snapshot_date >= DATE '2001-08-01', product_id, location_id, snapshot_timestamp) AS inventory_sk)
FROM s_inventory""")
cte("m_shipments_second_load", """
SELECT * REPLACE (ROW_NUMBER() OVER (ORDER BY ship_date >= DATE '1998-01-01', shipment_id) AS shipment_sk) FROM s_shipments""")
cte("s_customer_segments_before", CTES["s_customer_segments"].replace(AS_OF, f"CAST({AS_OF} - 1 AS DATE)"))
cte("m_customer_segments_two_days", "SELECT * FROM s_customer_segments UNION ALL SELECT * FROM s_customer_segments_before")
