"""Registered queries: conformance, lookups, metrics, identity, history, unified and gold tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stocktide.functions import labels
from stocktide.operators import crosswalk as xw
from stocktide.operators.common import first_per_key
from stocktide.operators import gold, identity, inventory as inv, scd2, shipments as shp, unified as uni
from stocktide.plans.ctes import AS_OF
from stocktide.plans.registry import query
from stocktide.sources.derived import Tables

DEMAND_FROM, DEMAND_TO = "2001-01-01", "2001-11-04"


def silver_shipments(t: Tables, feed: DataFrame | None = None) -> DataFrame:
    return shp.latest_version(shp.clean(t.shipment_feed() if feed is None else feed, AS_OF))


def clean_inventory(t: Tables) -> DataFrame:
    """Enough for anything that keeps one row per position: the latest row is the same with repeats left in."""
    return inv.clean(t.inventory_feed(), AS_OF)


def silver_inventory(t: Tables, feed: DataFrame | None = None) -> DataFrame:
    return first_per_key(inv.clean(t.inventory_feed() if feed is None else feed, AS_OF), inv.SNAPSHOT, [F.col("load_ts").desc_nulls_last()])


def supplier_dim(t: Tables) -> DataFrame:
    return scd2.build(t.supplier_feed())


def unified_whole(t: Tables, recent_days: int | None = None) -> DataFrame:
    return uni.build(clean_inventory(t), supplier_dim(t), t.crosswalk(), silver_shipments(t), t.supply_link(),
                     AS_OF, recent_days)


def positions(t: Tables) -> DataFrame:
    return uni.positions(clean_inventory(t), supplier_dim(t), t.crosswalk(), t.supply_link())


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


# --- shipments -------------------------------------------------------------------------------------------


@query("shipment_conform", using="fx_shipment", check="SELECT * FROM fx_shipment")
def _(t):
    """The feed in its bronze layout, brought to the silver layout."""
    raw = t.shipment_feed().withColumnsRenamed({
        **{f"{c}_ts": c for c in shp.TIME_COLUMNS}, "source_system": "_source_system", "load_ts": "_ingestion_ts"})
    return shp.conform(raw)


@query("shipment_clean", using="clean_shipment", check="SELECT * FROM clean_shipment")
def _(t):
    return shp.clean(t.shipment_feed(), AS_OF)


@query("shipment_latest", using="silver_shipment", check="SELECT * FROM silver_shipment")
def _(t):
    return silver_shipments(t)


@query("shipment_upsert", using="silver_shipment", check="SELECT * FROM silver_shipment")
def _(t):
    """Load everything up to 1999, then upsert the whole feed: the result is the latest row per id."""
    feed = t.shipment_feed()
    early = shp.latest_version(shp.clean(feed.filter(F.col("load_ts") < F.lit("1999-01-01").cast("timestamp_ntz")), AS_OF))
    return shp.upsert(early, feed, AS_OF)


@query("shipment_by_route", using="clean_shipment",
       check="SELECT * FROM clean_shipment WHERE route_id = 'ROUTE_0007'")
def _(t):
    return shp.by_route(shp.clean(t.shipment_feed(), AS_OF), "ROUTE_0007")


@query("shipment_by_carrier", using="clean_shipment",
       check="SELECT * FROM clean_shipment WHERE carrier_id = 'SUP_000003' AND status = 'delivered'")
def _(t):
    return shp.by_carrier(shp.clean(t.shipment_feed(), AS_OF), "SUP_000003", "delivered")


@query("shipment_active", using="clean_shipment", check="SELECT * FROM clean_shipment WHERE status = 'in_transit'")
def _(t):
    return shp.active(shp.clean(t.shipment_feed(), AS_OF))


@query("shipment_delayed", using="clean_shipment", check="""
SELECT * FROM clean_shipment
WHERE status = 'in_transit' AND actual_departure_ts > planned_departure_ts + INTERVAL 24 HOUR""")
def _(t):
    return shp.delayed(shp.clean(t.shipment_feed(), AS_OF), 24)


@query("shipment_recent_active", using="clean_shipment", check=f"""
SELECT * FROM clean_shipment WHERE status IN ('in_transit', 'delivered')
  AND planned_departure_ts >= CAST(TIMESTAMP '{AS_OF}' AS DATE) - INTERVAL 30 DAY""")
def _(t):
    return shp.recent_active(shp.clean(t.shipment_feed(), AS_OF), AS_OF, 30)


@query("delivery_metrics", using="clean_shipment", check="""
SELECT carrier_id, count(shipment_id) AS total_shipments,
       round(avg(CASE WHEN delay <= 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END), 6) AS on_time_rate,
       round(avg(delay), 6) AS avg_delay_hours
FROM (SELECT *, date_diff('second', planned_arrival_ts, actual_arrival_ts) / 3600.0::DOUBLE AS delay
      FROM clean_shipment
      WHERE status = 'delivered' AND actual_arrival_ts IS NOT NULL AND planned_arrival_ts IS NOT NULL)
GROUP BY carrier_id""")
def _(t):
    return rounded(shp.delivery_metrics(shp.clean(t.shipment_feed(), AS_OF)), "on_time_rate", "avg_delay_hours")


@query("lead_time", using="silver_shipment", check="""
SELECT carrier_id AS supplier_id, route_id, count(*) AS delivered_shipments,
       round(avg(date_diff('second', actual_departure_ts, actual_arrival_ts) / 3600.0::DOUBLE) / 24, 6) AS avg_lead_time_days
FROM silver_shipment
WHERE status = 'delivered' AND actual_departure_ts IS NOT NULL AND actual_arrival_ts IS NOT NULL
GROUP BY carrier_id, route_id""")
def _(t):
    return rounded(shp.lead_time(silver_shipments(t)), "avg_lead_time_days")


@query("capacity", using="fx_capacity", check="""
SELECT v.carrier_id, v.week_start, v.shipped_volume, c.weekly_capacity,
       round(v.shipped_volume / c.weekly_capacity, 6) AS utilisation
FROM (SELECT 'SUP_' || lpad(CAST(l_suppkey AS VARCHAR), 6, '0') AS carrier_id,
             CAST(date_trunc('week', l_shipdate) AS DATE) AS week_start, sum(l_quantity) AS shipped_volume
      FROM lineitem GROUP BY 1, 2) v LEFT JOIN fx_capacity c ON c.carrier_id = v.carrier_id""")
def _(t):
    return rounded(shp.capacity_utilisation(t.shipped_volume(), t.capacity()), "utilisation")


# --- inventory -------------------------------------------------------------------------------------------


@query("inventory_conform", using="fx_inventory", check="""
SELECT * REPLACE (coalesce(safety_stock, 0.0) AS safety_stock, coalesce(in_transit_qty, 0.0) AS in_transit_qty)
FROM fx_inventory""")
def _(t):
    return inv.conform(t.inventory_feed().withColumnsRenamed({"source_system": "_source_system", "load_ts": "_ingestion_ts"}))


@query("inventory_clean", using="clean_inventory", check="SELECT * FROM clean_inventory")
def _(t):
    return inv.clean(t.inventory_feed(), AS_OF)


@query("inventory_upsert", using="silver_inventory", check="SELECT * FROM silver_inventory")
def _(t):
    """Upsert the whole feed over what was loaded up to 1999: one row per snapshot."""
    feed = t.inventory_feed()
    before = F.col("load_ts") < F.lit("1999-01-01").cast("timestamp_ntz")
    empty = t.spark.createDataFrame([], feed.schema)
    return inv.upsert(inv.upsert(empty, feed.filter(before), AS_OF), feed, AS_OF)


@query("inventory_latest_rownum", using="latest_inventory", check="SELECT * FROM latest_inventory")
def _(t):
    return inv.latest(clean_inventory(t))


@query("inventory_latest_max", using="clean_inventory", check="""
SELECT * FROM clean_inventory i WHERE snapshot_date = (
  SELECT max(snapshot_date) FROM clean_inventory j WHERE j.item_id = i.item_id AND j.location_id = i.location_id)""")
def _(t):
    return inv.latest_with_ties(inv.clean(t.inventory_feed(), AS_OF))


@query("inventory_on_date", using="clean_inventory",
       check="SELECT * FROM clean_inventory WHERE snapshot_date = DATE '2000-03-01'")
def _(t):
    return inv.on_date(inv.clean(t.inventory_feed(), AS_OF), "2000-03-01")


@query("inventory_history", using="clean_inventory", check="""
SELECT * FROM clean_inventory WHERE item_id = 'ITEM_000042' AND location_id = 'WH003'
  AND snapshot_date >= DATE '2001-11-04' - 2000""")
def _(t):
    return inv.history(inv.clean(t.inventory_feed(), AS_OF), "ITEM_000042", "WH003", "2001-11-04", 2000)


@query("stockout_risk", using="latest_inventory", check="""
SELECT *, CASE WHEN quantity_on_hand = 0 THEN 'immediate' WHEN quantity_on_hand <= safety_stock THEN 'high'
               ELSE 'low' END AS stockout_risk
FROM latest_inventory WHERE quantity_on_hand <= safety_stock OR quantity_on_hand = 0""")
def _(t):
    return inv.stockout_risk(clean_inventory(t))


_LOCATION_METRICS = """
SELECT location_id, count(item_id) AS total_items, round(sum(quantity_on_hand), 6) AS total_on_hand,
       round(sum(safety_stock), 6) AS total_safety_stock, round(sum(in_transit_qty), 6) AS total_in_transit,
       count(risk) AS risk_labelled_items, count(*) FILTER (WHERE risk = 'stockout') AS stockout_items,
       count(*) FILTER (WHERE risk = 'at_risk') AS at_risk_items,
       count(*) FILTER (WHERE risk = 'healthy') AS healthy_items
FROM (SELECT *, CASE WHEN quantity_on_hand = 0 THEN 'stockout' WHEN quantity_on_hand <= safety_stock THEN 'at_risk'
                     ELSE 'healthy' END AS risk FROM latest_inventory)
GROUP BY location_id"""


@query("inventory_location_metrics", using="latest_inventory", check=_LOCATION_METRICS)
def location_metrics(t):
    return rounded(inv.location_metrics(clean_inventory(t)), "total_on_hand", "total_safety_stock", "total_in_transit")


@query("coverage_ratio", using="latest_inventory", check=f"""
SELECT location_id, total_items, total_on_hand, total_safety_stock, total_in_transit,
       round(total_on_hand / nullif(total_safety_stock, 0), 2) AS coverage_ratio FROM ({_LOCATION_METRICS})""")
def _(t):
    return inv.coverage_ratio(location_metrics(t)).orderBy(F.col("coverage_ratio").desc())


@query("inventory_turnover", using="silver_inventory", check="""
SELECT item_id, location_id, n AS snapshots, CASE WHEN n >= 2 THEN round(q, 6) END AS avg_inventory,
       round(rate, 6) AS turnover_rate, round(CASE WHEN rate > 0 THEN 1.0::DOUBLE / rate ELSE 0 END, 6) AS days_in_inventory
FROM (SELECT *, CASE WHEN n >= 2 AND q > 0 THEN 1.0::DOUBLE / greatest(q, 1.0) ELSE 0.0::DOUBLE END AS rate
      FROM (SELECT item_id, location_id, count(*) AS n, avg(quantity_on_hand) AS q FROM silver_inventory
            WHERE snapshot_date >= DATE '2001-11-04' - 730 GROUP BY item_id, location_id))""")
def _(t):
    return rounded(inv.turnover(silver_inventory(t), "2001-11-04", 730), "avg_inventory", "turnover_rate",
                   "days_in_inventory")


@query("sufficiency", using="latest_inventory fx_demand", check="""
SELECT i.item_id, i.location_id, i.snapshot_date, i.quantity_on_hand, i.safety_stock, i.in_transit_qty,
       coalesce(d.demand_qty, 0.0) AS demand_qty,
       round(quantity_on_hand + in_transit_qty - safety_stock - coalesce(d.demand_qty, 0.0), 6) AS projected_qty,
       quantity_on_hand + in_transit_qty - safety_stock - coalesce(d.demand_qty, 0.0) < 0 AS shortfall
FROM latest_inventory i LEFT JOIN fx_demand d ON d.item_id = i.item_id AND d.location_id = i.location_id""")
def _(t):
    return rounded(inv.sufficiency(clean_inventory(t), t.demand(DEMAND_FROM, DEMAND_TO)), "projected_qty")


@query("cost_overlay", using="silver_inventory fx_cost_reference", check="""
SELECT i.item_id, i.location_id, i.snapshot_date, i.quantity_on_hand, c.cost_currency, c.unit_cost,
       round(i.quantity_on_hand * c.unit_cost, 6) AS stock_value
FROM silver_inventory i LEFT JOIN fx_cost_reference c ON c.item_id = i.item_id
 AND i.snapshot_date >= c.effective_start_ts
 AND (c.effective_end_ts IS NULL OR i.snapshot_date < c.effective_end_ts)""")
def _(t):
    return rounded(inv.cost_overlay(silver_inventory(t), t.cost_reference()), "stock_value")


# --- crosswalk and identity --------------------------------------------------------------------------------


@query("crosswalk_best", using="best_mapping", check="SELECT * FROM best_mapping")
def _(t):
    return xw.best_mappings(t.crosswalk()).select(*xw.KEY, "business_key")


@query("crosswalk_resolve", using="fx_source_record best_mapping", check="""
SELECT r.source_system, r.source_key, r.entity_type, r.record_group, r.name, r.effective_start_ts, m.business_key
FROM fx_source_record r LEFT JOIN best_mapping m ON m.source_system = r.source_system
 AND m.source_key = r.source_key AND m.entity_type = r.entity_type""")
def _(t):
    return xw.resolve_keys(t.source_records(), t.crosswalk())


@query("crosswalk_integrity", using="fx_crosswalk", check="""
SELECT CAST(coalesce(sum(n), 0) AS BIGINT) AS total_active_mappings, count(*) FILTER (WHERE n > 1) AS duplicate_mappings
FROM (SELECT count(*) AS n FROM fx_crosswalk WHERE is_active GROUP BY source_system, source_key, entity_type)""")
def _(t):
    return xw.integrity(t.crosswalk())


@query("crosswalk_duplicates", using="fx_crosswalk", check="""
SELECT source_system, source_key, entity_type, count(*) AS mappings FROM fx_crosswalk WHERE is_active
GROUP BY source_system, source_key, entity_type HAVING count(*) > 1""")
def _(t):
    return xw.duplicate_mappings(t.crosswalk())


@query("crosswalk_by_entity", using="fx_crosswalk", check="""
SELECT source_system, source_key, business_key, confidence, created_ts FROM fx_crosswalk
WHERE is_active AND entity_type = 'supplier'""")
def _(t):
    return xw.mappings_for_entity(t.crosswalk(), "supplier")


@query("crosswalk_deactivate", using="fx_crosswalk fx_source_record", check=f"""
SELECT c.source_system, c.source_key, c.entity_type, c.business_key, c.confidence, c.created_ts,
       c.is_active AND k.source_key IS NULL AS is_active,
       CASE WHEN c.is_active AND k.source_key IS NOT NULL THEN TIMESTAMP '{AS_OF}' END AS updated_ts
FROM fx_crosswalk c LEFT JOIN (
  SELECT DISTINCT source_system, source_key, entity_type FROM fx_source_record WHERE effective_start_ts IS NULL) k
ON k.source_system = c.source_system AND k.source_key = c.source_key AND k.entity_type = c.entity_type""")
def _(t):
    """Deactivate the mappings of source records without an effective date."""
    return xw.deactivate(t.crosswalk(), t.source_records().filter(F.col("effective_start_ts").isNull()), AS_OF)


_RESOLVED = """
SELECT record_group, entity_type, source_system, source_key, name, effective_start_ts,
       coalesce(business_key, upper(entity_type) || '_' || source_system || '_' || source_key) AS business_key,
       trust_score, business_key IS NULL AS is_new_key
FROM (SELECT *, row_number() OVER (PARTITION BY record_group, entity_type
                                   ORDER BY (business_key IS NULL), trust_score, business_key) AS pick
      FROM (SELECT *, min(r) OVER (PARTITION BY record_group, entity_type, business_key) AS trust_score,
                   row_number() OVER (PARTITION BY record_group, entity_type, business_key
                       ORDER BY effective_start_ts DESC NULLS LAST, r, source_system, source_key) AS best
            FROM (SELECT s.*, m.business_key, CASE s.source_system WHEN 'erp_system' THEN 0 WHEN 'manual_entry' THEN 1
                         WHEN 'wms_system' THEN 2 ELSE 3 END AS r
                  FROM fx_source_record s LEFT JOIN best_mapping m ON m.source_system = s.source_system
                   AND m.source_key = s.source_key AND m.entity_type = s.entity_type))
      WHERE best = 1)
WHERE pick = 1"""


@query("identity_resolve", using="fx_source_record best_mapping", check=_RESOLVED)
def _(t):
    return identity.resolve(t.source_records(), t.crosswalk(), "supplier", "record_group")


@query("identity_new_keys", using="fx_source_record best_mapping", check=f"""
SELECT source_system, source_key, entity_type, business_key, CAST(1.0 AS DOUBLE) AS confidence
FROM ({_RESOLVED}) WHERE is_new_key""")
def _(t):
    return identity.new_mappings(identity.resolve(t.source_records(), t.crosswalk(), "supplier", "record_group"))


@query("identity_extended_crosswalk", using="fx_source_record best_mapping fx_crosswalk", check=f"""
SELECT source_system, source_key, entity_type, business_key, confidence, created_ts, is_active,
       CAST(NULL AS TIMESTAMP) AS updated_ts FROM fx_crosswalk
UNION ALL
SELECT source_system, source_key, entity_type, business_key, 1.0, TIMESTAMP '{AS_OF}', true, TIMESTAMP '{AS_OF}'
FROM ({_RESOLVED}) WHERE is_new_key""")
def _(t):
    return identity.resolve_and_extend(t.source_records(), t.crosswalk(), "supplier", AS_OF, "record_group")[1]


@query("identity_statistics", using="fx_crosswalk", check="""
SELECT CAST(coalesce(sum(n), 0) AS BIGINT) AS total_active_mappings, count(*) FILTER (WHERE n > 1) AS duplicate_mappings,
       4 AS resolution_rules, 5 AS trust_levels
FROM (SELECT count(*) AS n FROM fx_crosswalk WHERE is_active GROUP BY source_system, source_key, entity_type)""")
def _(t):
    return identity.statistics(t.crosswalk())


# --- supplier history --------------------------------------------------------------------------------------


@query("scd2_build", using="dim_supplier", check="SELECT * FROM dim_supplier")
def _(t):
    return supplier_dim(t)


@query("scd2_merge", using="dim_supplier", check="SELECT * FROM dim_supplier")
def _(t):
    """History up to 1999 plus the feed since then, rows in the past included: equals the full rebuild."""
    feed = t.supplier_feed()
    later = F.col("load_ts") >= F.lit("1999-01-01").cast("timestamp_ntz")
    dim = t.stored(scd2.build(feed.filter(~later)), "history")
    late = feed.filter(later).withColumn("effective_start_ts", F.col("load_ts"))
    return scd2.correct(dim, late)


@query("scd2_batch_merge", using="dim_supplier fx_supplier_feed", check="""
SELECT * FROM (SELECT natural_key, business_key, name, status, region, attributes_json, effective_start_ts,
       lead(effective_start_ts) OVER v AS effective_end_ts, lead(effective_start_ts) OVER v IS NULL AS is_current,
       source_system, load_ts
FROM (SELECT *, lag(load_ts) OVER w IS NULL OR lag(name) OVER w IS DISTINCT FROM name
             OR lag(status) OVER w IS DISTINCT FROM status OR lag(region) OVER w IS DISTINCT FROM region
             OR lag(attributes_json) OVER w IS DISTINCT FROM attributes_json AS opens
      FROM (SELECT *, load_ts AS effective_start_ts, row_number() OVER (PARTITION BY business_key ORDER BY load_ts DESC) AS k
            FROM fx_supplier_feed)
      WHERE load_ts < TIMESTAMP '2001-01-01' OR k = 1
      WINDOW w AS (PARTITION BY business_key ORDER BY load_ts))
WHERE opens WINDOW v AS (PARTITION BY business_key ORDER BY effective_start_ts))""")
def _(t):
    """One batch with several rows per key on top of the history before 2001: the latest row per key counts."""
    feed = t.supplier_feed()
    later = F.col("load_ts") >= F.lit("2001-01-01").cast("timestamp_ntz")
    return scd2.merge(t.stored(scd2.build(feed.filter(~later)), "history"), feed.filter(later))


@query("scd2_current", using="dim_supplier", check="SELECT * FROM dim_supplier WHERE is_current")
def _(t):
    return scd2.current(supplier_dim(t))


@query("scd2_as_of", using="dim_supplier", check="""
SELECT * FROM dim_supplier WHERE effective_start_ts <= TIMESTAMP '1998-05-17'
 AND (effective_end_ts IS NULL OR TIMESTAMP '1998-05-17' < effective_end_ts)""")
def _(t):
    return scd2.as_of(supplier_dim(t), "1998-05-17")


@query("scd2_history", using="dim_supplier", check="SELECT * FROM dim_supplier WHERE business_key = 'SUP_000007'")
def _(t):
    return scd2.history(supplier_dim(t), "SUP_000007")


@query("scd2_lookup", using="dim_supplier fx_source_record", check="""
SELECT * FROM dim_supplier WHERE is_current AND (natural_key, source_system) IN (
  SELECT (source_key, source_system) FROM fx_source_record WHERE effective_start_ts IS NOT NULL)""")
def _(t):
    """Current rows of the source keys that carry an effective date."""
    keys = t.source_records().filter("effective_start_ts IS NOT NULL").selectExpr("source_key AS natural_key", "source_system")
    return scd2.lookup_natural_keys(supplier_dim(t), keys)


@query("scd2_at_event_time", using="dim_supplier silver_shipment", check="""
SELECT s.shipment_id, s.carrier_id, s.planned_departure_ts, d.effective_start_ts AS version_start_ts,
       d.status AS supplier_status, d.region AS supplier_region
FROM silver_shipment s LEFT JOIN dim_supplier d ON d.business_key = s.carrier_id
 AND s.planned_departure_ts >= d.effective_start_ts
 AND (d.effective_end_ts IS NULL OR s.planned_departure_ts < d.effective_end_ts)""")
def _(t):
    moves = silver_shipments(t).select("shipment_id", "carrier_id", "planned_departure_ts")
    return scd2.at_event_time(moves, supplier_dim(t), "carrier_id", "planned_departure_ts")


@query("supplier_current_projection", using="dim_supplier", check="""
SELECT business_key AS supplier_id, name AS supplier_name, status AS supplier_status, region AS supplier_region,
       attributes_json AS supplier_attributes, effective_start_ts AS supplier_effective_start,
       source_system AS supplier_source FROM dim_supplier WHERE is_current""")
def _(t):
    return scd2.current_projection(supplier_dim(t))


# --- unified table -----------------------------------------------------------------------------------------


@query("unified_link", using="unified", check="SELECT * FROM unified")
def _(t):
    return unified_whole(t)


@query("unified_recent", using="unified_recent", check="SELECT * FROM unified_recent")
def _(t):
    return unified_whole(t, 30)


@query("unified_region_recent", using="unified_recent", check="""
SELECT product_id, location_id, supplier_name, supplier_region, quantity_on_hand, safety_stock, stock_status,
       shipment_status, delivery_delay_days, last_data_update_ts
FROM unified_recent WHERE supplier_region = 'EUROPE' AND inventory_date >= DATE '2001-11-04' - 7""")
def _(t):
    return uni.region_recent(unified_whole(t, 30), "EUROPE", "2001-11-04")


@query("unified_stockout", using="unified", check="""
SELECT product_id, location_id, supplier_name, quantity_on_hand, safety_stock, stock_status,
       CASE WHEN quantity_on_hand = 0 THEN 'IMMEDIATE' WHEN quantity_on_hand <= safety_stock THEN 'HIGH' ELSE 'LOW' END
         AS risk_level
FROM unified WHERE stock_status IN ('at_risk', 'stockout')""")
def _(t):
    return uni.stockout_report(unified_whole(t))


@query("unified_latest_updates", using="unified", check="""
SELECT * FROM unified ORDER BY last_data_update_ts DESC, product_id, location_id, supplier_id, shipment_id LIMIT 10""")
def _(t):
    return uni.latest_updates(unified_whole(t), 10)


@query("unified_records", using="unified", check="""
SELECT product_id, location_id, supplier_id, item_id, inventory_date AS snapshot_date, quantity_on_hand,
       CAST(count(shipment_id) AS INTEGER) AS shipment_count,
       coalesce(string_agg(shipment_id || ':' || shipment_status, ',' ORDER BY shipment_id), '') AS shipments
FROM unified WHERE inventory_date >= DATE '2000-01-01' AND inventory_date < DATE '2001-01-01'
GROUP BY 1, 2, 3, 4, 5, 6""")
def _(t):
    nested = uni.records(unified_whole(t), "2000-01-01", "2001-01-01")
    listed = F.transform("shipments", lambda s: F.concat(s["shipment_id"], F.lit(":"), s["status"]))
    return nested.select(
        "product_id", "location_id", "supplier_id", F.col("inventory.item_id").alias("item_id"),
        F.col("inventory.snapshot_date").alias("snapshot_date"),
        F.col("inventory.quantity_on_hand").alias("quantity_on_hand"),
        F.size("shipments").alias("shipment_count"), F.array_join(listed, ",").alias("shipments"),
    )


@query("stock_labels", using="clean_inventory", check="""
SELECT CASE WHEN quantity_on_hand <= safety_stock THEN 'at_risk' WHEN quantity_on_hand = 0 THEN 'stockout'
            ELSE 'healthy' END AS safety_first,
       CASE WHEN quantity_on_hand = 0 THEN 'stockout' WHEN quantity_on_hand <= safety_stock THEN 'at_risk'
            ELSE 'healthy' END AS zero_first, count(*) AS positions
FROM clean_inventory GROUP BY 1, 2""")
def _(t):
    q, s = F.col("quantity_on_hand"), F.col("safety_stock")
    return inv.clean(t.inventory_feed(), AS_OF).groupBy(
        labels.stock_label_safety_first(q, s).alias("safety_first"), labels.stock_label(q, s).alias("zero_first")
    ).agg(F.count("*").alias("positions"))


# --- gold tables -------------------------------------------------------------------------------------------


_SUPPLIER_PERFORMANCE = f"""
WITH moves AS (SELECT supplier_id, supplier_name, supplier_region, shipment_id, max(is_delivered) AS delivered,
                      max(delivery_delay_days) AS delay
               FROM unified WHERE supplier_id IS NOT NULL AND shipment_id IS NOT NULL GROUP BY 1, 2, 3, 4),
products AS (SELECT supplier_id, supplier_name, supplier_region, count(DISTINCT product_id) AS total_products
             FROM unified WHERE supplier_id IS NOT NULL GROUP BY 1, 2, 3),
metrics AS (SELECT supplier_id, supplier_name, supplier_region, count(*) AS total_shipments,
                   count(*) FILTER (WHERE delivered) AS delivered_shipments,
                   avg(CAST(delivered AS INTEGER)) AS delivered_rate,
                   count(*) FILTER (WHERE delivered AND delay <= 0) AS on_time_deliveries,
                   avg(CASE WHEN delivered AND delay <= 0 THEN 1 ELSE 0 END) AS on_time_rate,
                   avg(delay) AS avg_delay_days FROM moves GROUP BY 1, 2, 3)
SELECT p.supplier_id, p.supplier_name, p.supplier_region, coalesce(total_shipments, 0) AS total_shipments,
       coalesce(delivered_shipments, 0) AS delivered_shipments, round(delivered_rate, 6) AS delivered_rate,
       coalesce(on_time_deliveries, 0) AS on_time_deliveries, round(on_time_rate, 6) AS on_time_rate,
       round(avg_delay_days, 6) AS avg_delay_days, p.total_products, CAST(0.0 AS DOUBLE) AS avg_inventory_turnover,
       CAST(CASE WHEN delivered_rate >= 0.9 THEN 5.0 WHEN delivered_rate >= 0.8 THEN 4.0 WHEN delivered_rate >= 0.7 THEN 3.0
                 WHEN delivered_rate >= 0.6 THEN 2.0 ELSE 1.0 END AS DOUBLE) AS performance_score,
       TIMESTAMP '{AS_OF}' AS last_updated
FROM products p LEFT JOIN metrics m ON m.supplier_id = p.supplier_id
 AND m.supplier_name IS NOT DISTINCT FROM p.supplier_name AND m.supplier_region IS NOT DISTINCT FROM p.supplier_region"""


@query("supplier_performance", using="unified", check=_SUPPLIER_PERFORMANCE)
def _(t):
    moves = shp.recent_active(silver_shipments(t), AS_OF, None)
    return rounded(gold.supplier_performance_direct(positions(t), moves, AS_OF), "delivered_rate", "on_time_rate",
                   "avg_delay_days")


@query("supplier_performance_unified", using="unified", check=_SUPPLIER_PERFORMANCE)
def _(t):
    """The same metrics read off the unified table."""
    return rounded(gold.supplier_performance(unified_whole(t), AS_OF), "delivered_rate", "on_time_rate", "avg_delay_days")


_LITERAL_SUPPLIER = f"""
SELECT supplier_id, supplier_name, supplier_region, count(DISTINCT shipment_id) AS total_shipments,
       count(*) FILTER (WHERE is_delivered) AS on_time_deliveries,
       round(avg(CASE WHEN is_delivered THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END), 6) AS on_time_rate,
       round(avg(delivery_delay_days), 6) AS avg_delay_days, count(DISTINCT product_id) AS total_products,
       CAST(0.0 AS DOUBLE) AS avg_inventory_turnover,
       CAST(CASE WHEN avg(CASE WHEN is_delivered THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) >= 0.9 THEN 5.0
            WHEN avg(CASE WHEN is_delivered THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) >= 0.8 THEN 4.0
            WHEN avg(CASE WHEN is_delivered THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) >= 0.7 THEN 3.0
            WHEN avg(CASE WHEN is_delivered THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) >= 0.6 THEN 2.0
            ELSE 1.0 END AS DOUBLE) AS performance_score, TIMESTAMP '{AS_OF}' AS last_updated
FROM unified WHERE supplier_id IS NOT NULL GROUP BY supplier_id, supplier_name, supplier_region"""


@query("supplier_performance_literal", using="unified", check=_LITERAL_SUPPLIER)
def literal_supplier(t):
    return rounded(gold.supplier_performance_literal(unified_whole(t), AS_OF), "on_time_rate", "avg_delay_days")


@query("supplier_ranking", using="unified", check=f"""
SELECT supplier_name, supplier_region, total_shipments, on_time_deliveries, on_time_rate, avg_delay_days,
       performance_score FROM ({_LITERAL_SUPPLIER})""")
def _(t):
    return gold.supplier_ranking(literal_supplier(t))


def _stock_sql(source: str) -> str:
    return f"""
SELECT product_id, location_id, supplier_id, sum(quantity_on_hand) AS total_inventory,
       round(avg(safety_stock), 6) AS safety_stock_level,
       CASE WHEN sum(quantity_on_hand) = 0 THEN 'stockout' WHEN sum(quantity_on_hand) <= avg(safety_stock) THEN 'at_risk'
            ELSE 'healthy' END AS stockout_risk, CAST(0.0 AS DOUBLE) AS turnover_rate,
       CAST(0.0 AS DOUBLE) AS days_in_inventory, max(inventory_date) AS last_movement_date,
       TIMESTAMP '{AS_OF}' AS last_updated
FROM {source} GROUP BY product_id, location_id, supplier_id"""


@query("inventory_metrics", using="position", check=_stock_sql("position"))
def _(t):
    return rounded(gold.inventory_metrics(positions(t), AS_OF), "safety_stock_level")


@query("inventory_metrics_literal", using="unified", check=_stock_sql("unified"))
def _(t):
    return rounded(gold.inventory_metrics_literal(unified_whole(t), AS_OF), "safety_stock_level")


@query("shipment_performance", using="silver_shipment", check=f"""
SELECT carrier_id, route_id, count(*) AS total_shipments, count(*) FILTER (WHERE delivered) AS delivered_shipments,
       count(*) FILTER (WHERE delay > 0) AS delayed_shipments,
       count(*) FILTER (WHERE status = 'cancelled') AS cancelled_shipments,
       round(avg(CASE WHEN delivered THEN 1.0::DOUBLE ELSE 0 END), 6) AS delivered_rate,
       count(*) FILTER (WHERE delivered AND delay <= 0) AS on_time_shipments,
       round(avg(CASE WHEN delivered AND delay <= 0 THEN 1.0::DOUBLE ELSE 0 END), 6) AS on_time_rate,
       round(avg(delay), 6) AS avg_delay_days,
       round(avg(date_diff('second', planned_arrival_ts, actual_arrival_ts) / 3600.0::DOUBLE), 6) AS avg_delay_hours,
       round(avg(date_diff('day', planned_departure_ts, coalesce(actual_arrival_ts, planned_arrival_ts))), 6) AS avg_transit_days,
       TIMESTAMP '{AS_OF}' AS last_updated
FROM (SELECT *, status = 'delivered' AND actual_arrival_ts IS NOT NULL AS delivered,
             date_diff('day', planned_arrival_ts, actual_arrival_ts) AS delay FROM silver_shipment)
WHERE carrier_id IS NOT NULL GROUP BY carrier_id, route_id""")
def _(t):
    return rounded(gold.shipment_performance(silver_shipments(t), AS_OF), "delivered_rate", "on_time_rate",
                   "avg_delay_days", "avg_delay_hours", "avg_transit_days")


@query("shipment_performance_literal", using="unified", check=f"""
SELECT carrier_id, route_id, count(*) AS total_shipments, count(*) FILTER (WHERE is_delivered) AS on_time_shipments,
       count(*) FILTER (WHERE delivery_delay_days > 0) AS delayed_shipments,
       count(*) FILTER (WHERE shipment_status = 'cancelled') AS cancelled_shipments,
       round(avg(CASE WHEN is_delivered THEN 1.0::DOUBLE ELSE 0 END), 6) AS on_time_rate,
       round(avg(delivery_delay_days), 6) AS avg_delay_hours,
       round(avg(date_diff('day', planned_departure_ts, coalesce(actual_arrival_ts, planned_arrival_ts))), 6) AS avg_transit_days,
       TIMESTAMP '{AS_OF}' AS last_updated
FROM unified WHERE carrier_id IS NOT NULL GROUP BY carrier_id, route_id""")
def _(t):
    return rounded(gold.shipment_performance_literal(unified_whole(t), AS_OF), "on_time_rate", "avg_delay_hours",
                   "avg_transit_days")


@query("supplier_performance_crossed", using="clean_inventory dim_supplier fx_crosswalk silver_shipment", check=f"""
WITH current_inventory AS (
  SELECT * FROM clean_inventory i WHERE snapshot_date = (
    SELECT max(snapshot_date) FROM clean_inventory j WHERE j.item_id = i.item_id AND j.location_id = i.location_id)),
active AS (SELECT * FROM silver_shipment WHERE status IN ('in_transit', 'delivered')
           AND planned_departure_ts >= CAST(TIMESTAMP '{AS_OF}' AS DATE) - INTERVAL 365 DAY),
crossed AS (
  SELECT coalesce(pc.business_key, ci.item_id) AS product_id, coalesce(sc.business_key, cs.business_key) AS supplier_id,
         cs.name AS supplier_name, cs.region AS supplier_region, s.shipment_id,
         date_diff('day', s.planned_arrival_ts, s.actual_arrival_ts) AS delay,
         coalesce(s.status = 'delivered' AND s.actual_arrival_ts IS NOT NULL, false) AS is_delivered
  FROM current_inventory ci
  LEFT JOIN fx_crosswalk pc ON pc.entity_type = 'product' AND pc.source_key = ci.item_id
  LEFT JOIN (SELECT * FROM dim_supplier WHERE is_current) cs ON 1 = 1
  LEFT JOIN fx_crosswalk sc ON sc.entity_type = 'supplier' AND sc.source_key = cs.business_key
  LEFT JOIN active s ON s.carrier_id = sc.business_key AND s.planned_departure_ts >= ci.snapshot_date - INTERVAL 7 DAY
   AND s.planned_departure_ts <= ci.snapshot_date + INTERVAL 7 DAY)
SELECT supplier_id, supplier_name, supplier_region, count(DISTINCT shipment_id) AS total_shipments,
       count(*) FILTER (WHERE is_delivered) AS on_time_deliveries,
       round(count(*) FILTER (WHERE is_delivered) / count(*)::DOUBLE, 6) AS on_time_rate,
       round(avg(delay), 6) AS avg_delay_days, count(DISTINCT product_id) AS total_products, count(*) AS joined_rows,
       CAST(0.0 AS DOUBLE) AS avg_inventory_turnover,
       CAST(CASE WHEN avg(is_delivered::INT) >= 0.9 THEN 5 WHEN avg(is_delivered::INT) >= 0.8 THEN 4
                 WHEN avg(is_delivered::INT) >= 0.7 THEN 3 WHEN avg(is_delivered::INT) >= 0.6 THEN 2 ELSE 1 END AS DOUBLE)
         AS performance_score,
       TIMESTAMP '{AS_OF}' AS last_updated
FROM crossed GROUP BY supplier_id, supplier_name, supplier_region""")
def _(t):
    """Every position against every supplier, over the last year of shipments."""
    out = gold.supplier_performance_crossed(clean_inventory(t), supplier_dim(t), t.crosswalk(), silver_shipments(t),
                                            AS_OF, 365)
    return rounded(out, "on_time_rate", "avg_delay_days")
