"""SQL definitions of the derived tables, used by the checks only."""

from __future__ import annotations

from collections.abc import Sequence

# Instant that stands for "now" in registered queries.
AS_OF = "2001-11-04 00:04:00"

DERIVED: dict[str, tuple[str, str]] = {}  # name -> (tables it reads, SQL)


def _define(name: str, needs: str, sql: str) -> None:
    DERIVED[name] = (needs, sql)


_define("fx_supplier_feed", "", """
SELECT 'SUP_' || lpad(CAST(f.l_suppkey AS VARCHAR), 6, '0') AS natural_key,
       'SUP_' || lpad(CAST(f.l_suppkey AS VARCHAR), 6, '0') AS business_key,
       s.s_name AS name,
       CASE WHEN f.n % 10 < 6 THEN 'active' WHEN f.n % 10 < 8 THEN 'inactive'
            WHEN f.n % 10 = 8 THEN 'pending' ELSE 'suspended' END AS status,
       CASE WHEN f.n % 7 = 0 THEN NULL ELSE r.r_name END AS region,
       '{"tier": ' || CAST(f.l_suppkey % 3 + 1 AS VARCHAR) || '}' AS attributes_json,
       'erp_system' AS source_system, CAST(f.load_ts AS TIMESTAMP) AS load_ts
FROM (SELECT l_suppkey, CAST(date_trunc('quarter', l_shipdate) AS DATE) AS load_ts, COUNT(*) AS n
      FROM lineitem GROUP BY l_suppkey, CAST(date_trunc('quarter', l_shipdate) AS DATE)) f
JOIN supplier s ON f.l_suppkey = s.s_suppkey
JOIN nation n ON s.s_nationkey = n.n_nationkey
JOIN region r ON n.n_regionkey = r.r_regionkey""")

_define("fx_shipment", "", """
SELECT 'SHIP_' || CAST(l.l_orderkey AS VARCHAR) || '_' || CAST(l.l_linenumber AS VARCHAR) AS shipment_id,
       'ROUTE_' || lpad(CAST(l.l_partkey % 20 AS VARCHAR), 4, '0') AS route_id,
       'SUP_' || lpad(CAST(l.l_suppkey AS VARCHAR), 6, '0') AS carrier_id,
       n.n_name AS origin, c.c_mktsegment AS destination,
       l.l_shipdate AS planned_departure_ts,
       CASE WHEN l.l_linestatus = 'F' THEN l.l_shipdate + INTERVAL '1' HOUR * CAST(l.l_quantity AS INT) END
         AS actual_departure_ts,
       l.l_shipdate + INTERVAL '1' DAY * (l.l_linenumber - 1) AS planned_arrival_ts,
       CASE WHEN l.l_returnflag = 'A' THEN l.l_shipdate + INTERVAL '1' DAY * (l.l_linenumber - 1)
            + INTERVAL '1' HOUR * (CAST(l.l_quantity AS INT) - 25) END AS actual_arrival_ts,
       CASE WHEN l.l_returnflag = 'A' THEN 'delivered'
            WHEN l.l_returnflag = 'R' AND l.l_linestatus = 'F' THEN 'in_transit'
            WHEN l.l_returnflag = 'R' THEN 'cancelled'
            WHEN l.l_linestatus = 'F' THEN 'planned' ELSE 'UNKNOWN' END AS status,
       o.o_orderdate AS load_ts, 'wms_system' AS source_system
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
JOIN customer c ON o.o_custkey = c.c_custkey
JOIN nation n ON c.c_nationkey = n.n_nationkey""")

_define("fx_inventory", "", """
SELECT 'ITEM_' || lpad(CAST(l.l_partkey AS VARCHAR), 6, '0') AS item_id,
       'WH' || lpad(CAST(l.l_suppkey % 5 + 1 AS VARCHAR), 3, '0') AS location_id,
       CAST(l.l_shipdate AS DATE) AS snapshot_date,
       l.l_quantity - 5.0 AS quantity_on_hand,
       CASE WHEN l.l_returnflag = 'N' THEN NULL ELSE CAST(p.p_size AS DOUBLE) / 2 END AS safety_stock,
       l.l_tax * 100 - 2.0 AS in_transit_qty,
       l.l_shipdate AS load_ts, 'wms_system' AS source_system
FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey""")

_define("fx_crosswalk", "", """
SELECT 'erp_system' AS source_system, 'SUP_' || lpad(CAST(s_suppkey AS VARCHAR), 6, '0') AS source_key,
       'supplier' AS entity_type, 'SUP_' || lpad(CAST(s_suppkey AS VARCHAR), 6, '0') AS business_key,
       CAST(1.0 AS DOUBLE) AS confidence, TIMESTAMP '2001-01-01' AS created_ts, s_suppkey % 20 <> 19 AS is_active
FROM supplier
UNION ALL
SELECT 'wms_system', 'VENDOR_' || CAST(s_suppkey AS VARCHAR), 'supplier',
       'SUP_' || lpad(CAST(s_suppkey - s_suppkey % 2 AS VARCHAR), 6, '0'), CAST(0.9 AS DOUBLE),
       TIMESTAMP '2001-02-01', true
FROM supplier
UNION ALL
SELECT 'wms_system', 'VENDOR_' || CAST(s_suppkey AS VARCHAR), 'supplier',
       'SUP_' || lpad(CAST(s_suppkey AS VARCHAR), 6, '0'), CAST(0.5 AS DOUBLE), TIMESTAMP '2001-03-01', true
FROM supplier WHERE s_suppkey % 25 = 1
UNION ALL
SELECT 'erp_system', 'ITEM_' || lpad(CAST(p_partkey AS VARCHAR), 6, '0'), 'product',
       'PROD_' || CAST(p_partkey AS VARCHAR), CAST(1.0 AS DOUBLE), TIMESTAMP '2001-01-01', true
FROM part WHERE p_partkey % 4 <> 3""")

_define("fx_source_record", "", """
SELECT CAST(s_suppkey AS VARCHAR) AS record_group, 'supplier' AS entity_type, 'erp_system' AS source_system,
       'SUP_' || lpad(CAST(s_suppkey AS VARCHAR), 6, '0') AS source_key, s_name AS name,
       TIMESTAMP '2000-01-01' AS effective_start_ts FROM supplier WHERE s_suppkey % 10 <> 7
UNION ALL
SELECT CAST(s_suppkey AS VARCHAR), 'supplier', 'wms_system', 'VENDOR_' || CAST(s_suppkey AS VARCHAR), 'wms ' || s_name,
       CASE WHEN s_suppkey % 5 = 0 THEN NULL ELSE TIMESTAMP '2000-06-01' END FROM supplier WHERE s_suppkey % 10 <> 7
UNION ALL
SELECT CAST(s_suppkey AS VARCHAR), 'supplier', 'external_api', 'X' || CAST(s_suppkey AS VARCHAR), 'api ' || s_name,
       TIMESTAMP '2000-09-01' FROM supplier WHERE s_suppkey % 10 IN (0, 7)""")

_define("fx_cost_reference", "", """
SELECT 'ITEM_' || lpad(CAST(p_partkey AS VARCHAR), 6, '0') AS item_id, v.effective_start_ts, 'USD' AS cost_currency,
       p_retailprice * v.factor AS unit_cost, v.effective_end_ts, v.effective_end_ts IS NULL AS is_current
FROM part CROSS JOIN (
      SELECT TIMESTAMP '1995-01-01' AS effective_start_ts, TIMESTAMP '1998-01-01' AS effective_end_ts, 1 AS factor
      UNION ALL SELECT TIMESTAMP '1998-01-01', NULL, 2) v""")

_define("fx_link", "", """
SELECT 'ITEM_' || lpad(CAST(l_partkey AS VARCHAR), 6, '0') AS item_id,
       'WH' || lpad(CAST(l_suppkey % 5 + 1 AS VARCHAR), 3, '0') AS location_id,
       'SUP_' || lpad(CAST(min(l_suppkey) AS VARCHAR), 6, '0') AS supplier_id
FROM lineitem GROUP BY l_partkey, l_suppkey % 5""")

_define("fx_demand", "", """
SELECT 'ITEM_' || lpad(CAST(l_partkey AS VARCHAR), 6, '0') AS item_id,
       'WH' || lpad(CAST(l_suppkey % 5 + 1 AS VARCHAR), 3, '0') AS location_id, sum(l_quantity) AS demand_qty
FROM lineitem WHERE l_shipdate >= TIMESTAMP '2001-01-01' AND l_shipdate < TIMESTAMP '2001-11-04'
GROUP BY l_partkey, l_suppkey % 5""")

_define("fx_capacity", "", """
SELECT 'SUP_' || lpad(CAST(s_suppkey AS VARCHAR), 6, '0') AS carrier_id,
       CAST(100 + s_suppkey % 5 * 20 AS DOUBLE) AS weekly_capacity
FROM supplier""")

_define("fx_shipment_text", "", """
SELECT CASE WHEN l_partkey % 97 = 0 THEN repeat('SHIP_', 11)
            ELSE 'SHIP_' || CAST(l_orderkey AS VARCHAR) || '_' || CAST(l_linenumber AS VARCHAR) END AS shipment_id,
       'ROUTE_' || lpad(CAST(l_partkey % 20 AS VARCHAR), 4, '0') AS route_id,
       CASE WHEN l_suppkey % 50 <> 13 THEN 'SUP_' || lpad(CAST(l_suppkey AS VARCHAR), 6, '0') END AS carrier_id,
       l_returnflag AS origin,
       CASE WHEN CAST(l_quantity AS INT) <> 7 THEN l_linestatus END AS destination,
       CASE WHEN CAST(l_quantity AS INT) = 11 THEN 'not a time' ELSE strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') END
         AS planned_departure,
       CAST(NULL AS VARCHAR) AS actual_departure,
       strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS planned_arrival,
       CAST(NULL AS VARCHAR) AS actual_arrival,
       CASE WHEN l_returnflag = 'A' THEN 'delivered' WHEN l_linestatus = 'F' THEN 'in_transit' ELSE 'lost' END AS status,
       CASE WHEN CAST(l_quantity AS INT) = 13 THEN 'heavy' ELSE CAST(CAST(l_quantity AS INT) - 2 AS VARCHAR) END AS weight,
       CAST(CAST(l_quantity AS INT) AS VARCHAR) AS volume
FROM lineitem""")

_define("clean_shipment", "fx_shipment", """
SELECT shipment_id, route_id, carrier_id, origin, destination,
       CASE WHEN planned_departure_ts > planned_arrival_ts THEN planned_arrival_ts ELSE planned_departure_ts END
         AS planned_departure_ts,
       CASE WHEN actual_departure_ts > actual_arrival_ts THEN actual_arrival_ts ELSE actual_departure_ts END
         AS actual_departure_ts,
       planned_arrival_ts, actual_arrival_ts,
       CASE WHEN status IN ('planned', 'in_transit', 'delivered', 'cancelled') THEN status ELSE 'planned' END AS status,
       load_ts, source_system
FROM fx_shipment""")

_define("silver_shipment", "clean_shipment", """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY shipment_id ORDER BY load_ts DESC NULLS LAST,
      actual_arrival_ts ASC NULLS LAST, actual_departure_ts ASC NULLS LAST, carrier_id ASC NULLS LAST,
      destination ASC NULLS LAST, load_ts ASC NULLS LAST, origin ASC NULLS LAST, planned_arrival_ts ASC NULLS LAST,
      planned_departure_ts ASC NULLS LAST, route_id ASC NULLS LAST, source_system ASC NULLS LAST,
      status ASC NULLS LAST) AS rn
  FROM clean_shipment) WHERE rn = 1""")

_define("clean_inventory", "fx_inventory", """
SELECT item_id, location_id, snapshot_date, greatest(coalesce(quantity_on_hand, 0.0), 0.0) AS quantity_on_hand,
       greatest(coalesce(safety_stock, 0.0), 0.0) AS safety_stock,
       greatest(coalesce(in_transit_qty, 0.0), 0.0) AS in_transit_qty, load_ts, source_system
FROM fx_inventory""")

_define("silver_inventory", "clean_inventory", """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY item_id, location_id, snapshot_date ORDER BY load_ts DESC NULLS LAST,
      in_transit_qty ASC NULLS LAST, quantity_on_hand ASC NULLS LAST, safety_stock ASC NULLS LAST,
      source_system ASC NULLS LAST) AS rn
  FROM clean_inventory) WHERE rn = 1""")

_define("latest_inventory", "silver_inventory", """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY item_id, location_id ORDER BY snapshot_date DESC) AS rn
  FROM silver_inventory) WHERE rn = 1""")

_define("dim_supplier", "fx_supplier_feed", """
SELECT natural_key, business_key, name, status, region, attributes_json, load_ts AS effective_start_ts,
       lead(load_ts) OVER (PARTITION BY business_key ORDER BY load_ts) AS effective_end_ts,
       lead(load_ts) OVER (PARTITION BY business_key ORDER BY load_ts) IS NULL AS is_current,
       source_system, load_ts
FROM (SELECT *, lag(load_ts) OVER w IS NULL
             OR lag(name) OVER w IS DISTINCT FROM name OR lag(status) OVER w IS DISTINCT FROM status
             OR lag(region) OVER w IS DISTINCT FROM region
             OR lag(attributes_json) OVER w IS DISTINCT FROM attributes_json AS opens
      FROM fx_supplier_feed WINDOW w AS (PARTITION BY business_key ORDER BY load_ts))
WHERE opens""")

_define("best_mapping", "fx_crosswalk", """
SELECT source_system, source_key, entity_type, business_key FROM (
  SELECT *, row_number() OVER (PARTITION BY source_system, source_key, entity_type
                               ORDER BY confidence DESC, created_ts DESC, business_key) AS rn
  FROM fx_crosswalk WHERE is_active) WHERE rn = 1""")

_define("entity_mapping", "fx_crosswalk", """
SELECT entity_type, source_key, business_key FROM (
  SELECT *, row_number() OVER (PARTITION BY source_key, entity_type
                               ORDER BY confidence DESC, created_ts DESC, business_key) AS rn
  FROM fx_crosswalk WHERE is_active) WHERE rn = 1""")

_define("position", "latest_inventory fx_link entity_mapping dim_supplier", """
SELECT coalesce(p.business_key, i.item_id) AS product_id, i.item_id, i.location_id,
       coalesce(m.business_key, s.business_key) AS supplier_id, s.name AS supplier_name, s.status AS supplier_status,
       s.region AS supplier_region, s.attributes_json AS supplier_attributes,
       i.quantity_on_hand, i.safety_stock, i.in_transit_qty, i.snapshot_date AS inventory_date,
       i.source_system AS inventory_source, s.source_system AS supplier_source, i.load_ts AS inventory_load_ts
FROM latest_inventory i
LEFT JOIN fx_link k ON k.item_id = i.item_id AND k.location_id = i.location_id
LEFT JOIN (SELECT * FROM dim_supplier WHERE is_current) s ON s.business_key = k.supplier_id
LEFT JOIN entity_mapping m ON m.entity_type = 'supplier' AND m.source_key = s.business_key
LEFT JOIN entity_mapping p ON p.entity_type = 'product' AND p.source_key = i.item_id""")

_UNIFIED = """
SELECT p.product_id, p.location_id, p.supplier_id, p.supplier_name, p.supplier_status, p.supplier_region,
       p.supplier_attributes, p.quantity_on_hand, p.safety_stock, p.in_transit_qty, p.inventory_date,
       s.shipment_id, s.route_id, s.carrier_id, s.origin, s.destination, s.planned_departure_ts,
       s.actual_departure_ts, s.planned_arrival_ts, s.actual_arrival_ts, s.status AS shipment_status,
       p.inventory_source, p.supplier_source, s.source_system AS shipment_source, p.inventory_load_ts,
       s.load_ts AS shipment_load_ts,
       CASE WHEN p.quantity_on_hand <= p.safety_stock THEN 'at_risk' WHEN p.quantity_on_hand = 0 THEN 'stockout'
            ELSE 'healthy' END AS stock_status,
       CAST(date_diff('day', s.planned_arrival_ts, s.actual_arrival_ts) AS INTEGER) AS delivery_delay_days,
       coalesce(s.status = 'delivered' AND s.actual_arrival_ts IS NOT NULL, false) AS is_delivered,
       TIMESTAMP '{as_of}' AS view_created_ts,
       greatest(coalesce(p.inventory_load_ts, TIMESTAMP '1900-01-01'), coalesce(s.load_ts, TIMESTAMP '1900-01-01'))
         AS last_data_update_ts,
       p.item_id
FROM position p LEFT JOIN (
  SELECT * FROM silver_shipment WHERE status IN ('in_transit', 'delivered'){recent}) s
ON s.carrier_id = p.supplier_id AND s.planned_departure_ts >= p.inventory_date - INTERVAL 7 DAY
   AND s.planned_departure_ts <= p.inventory_date + INTERVAL 7 DAY"""

_define("unified", "position silver_shipment", _UNIFIED.format(as_of=AS_OF, recent=""))
_define("unified_recent", "position silver_shipment", _UNIFIED.format(
    as_of=AS_OF, recent=f" AND planned_departure_ts >= CAST(TIMESTAMP '{AS_OF}' AS DATE) - INTERVAL 30 DAY"))


def with_tables(names: Sequence[str], body: str) -> str:
    """``body`` with the named derived tables, and what they read, in front."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        if name in ordered:
            return
        for needed in DERIVED[name][0].split():
            visit(needed)
        ordered.append(name)

    for name in names:
        visit(name)
    body = body.strip()
    if not ordered:
        return body
    ctes = ",\n".join(f"{n} AS ({DERIVED[n][1].strip()}\n)" for n in ordered)
    if body.startswith("WITH "):
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{body}"
