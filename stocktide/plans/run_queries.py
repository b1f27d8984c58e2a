"""Registered queries of whole runs: given tables to files, ingested and conformed in two batches, the second of an earlier instant."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stocktide.operators import inventory as inv
from stocktide.operators.common import in_parts, parts_of
from stocktide.plans.ctes import AS_OF
from stocktide.plans import queries as q
from stocktide.plans.registry import CHECKS, query
from stocktide.plans.runner import CROSSWALK, GOLD, LINK, SILVER, Job
from stocktide.session import release, scratch_dir
from stocktide.sources.store import Store

EARLIER = "2001-11-01 00:00:00"
#: Most parts that silver tables of a given size are made in.
SILVER_PARTS = 4
TIMES = ("planned_departure", "actual_departure", "planned_arrival", "actual_arrival")


def _two_batches(t, domain: str, rows: DataFrame, suffix: str, late: bool = False, crosswalk: DataFrame | None = None,
                 source_system: str | None = None) -> DataFrame:
    """The rows marked ``recent`` arrive first; the others follow in a batch whose instant lies before theirs, and are not lost.

    Both deliveries are written by one job, as compressed text: it is the largest thing a run writes.
    """
    store = Store(t.spark, scratch_dir(t.spark, "lake"), buckets=8)
    if crosswalk is not None:
        store.replace(crosswalk, CROSSWALK, [])
    path = scratch_dir(t.spark, domain)
    rows = rows.withColumn("delivery", F.when(F.col("recent"), "recent").otherwise("old")).drop("recent")
    writer = rows.write.partitionBy("delivery").option("compression", "gzip")
    (writer.json(path) if suffix == ".json" else writer.option("header", True).csv(path))
    for delivery, as_of in (("recent", AS_OF), ("old", EARLIER)):
        if not store.log.files.names(f"{path}/delivery={delivery}"):
            continue  # no row of that time
        job = Job(store, as_of, mint=crosswalk is not None)
        job.ingest(domain, f"{path}/delivery={delivery}", suffix[1:], source_system=source_system)
        if late and as_of == EARLIER:
            job.apply_late(domain)
        else:
            job.conform(domain)
    return store.read(SILVER[domain]).drop("created_at")


_SHIPMENTS = f"""
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY shipment_id ORDER BY load_ts DESC NULLS LAST,
      actual_arrival_ts ASC NULLS LAST, actual_departure_ts ASC NULLS LAST, carrier_id ASC NULLS LAST,
      destination ASC NULLS LAST, load_ts ASC NULLS LAST, origin ASC NULLS LAST, planned_arrival_ts ASC NULLS LAST,
      planned_departure_ts ASC NULLS LAST, route_id ASC NULLS LAST, source_system ASC NULLS LAST,
      status ASC NULLS LAST) AS rn
  FROM (SELECT shipment_id, route_id, carrier_id, origin, destination,
               CASE WHEN planned_departure_ts > planned_arrival_ts THEN planned_arrival_ts ELSE planned_departure_ts END
                 AS planned_departure_ts,
               CASE WHEN actual_departure_ts > actual_arrival_ts THEN actual_arrival_ts ELSE actual_departure_ts END
                 AS actual_departure_ts,
               planned_arrival_ts, actual_arrival_ts, status,
               CASE WHEN load_ts >= TIMESTAMP '1997-01-01' THEN TIMESTAMP '{AS_OF}' ELSE TIMESTAMP '{EARLIER}' END AS load_ts,
               'logistics_system' AS source_system
        FROM fx_shipment WHERE status <> 'UNKNOWN')) WHERE rn = 1"""


def _shipments(t, late: bool) -> DataFrame:
    feed = t.shipment_feed()
    raw = feed.select(
        "shipment_id", "route_id", "carrier_id", "origin", "destination", "status", "load_ts",
        *[F.date_format(F.col(f"{c}_ts"), "yyyy-MM-dd HH:mm:ss").alias(c) for c in TIMES])
    recent = F.col("load_ts") >= F.lit("1997-01-01").cast("timestamp_ntz")
    return _two_batches(t, "shipment", raw.withColumn("recent", recent).drop("load_ts"), ".json", late)


@query("run_silver_shipment", using="fx_shipment", check=_SHIPMENTS)
def _(t):
    return _shipments(t, late=False)


@query("run_late_shipment", using="fx_shipment", check=_SHIPMENTS)
def _(t):
    """The second batch through the late run, which picks it by its instant."""
    return _shipments(t, late=True)


@query("run_silver_inventory", using="fx_inventory", check=f"""
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY item_id, location_id, snapshot_date ORDER BY load_ts DESC NULLS LAST,
      in_transit_qty ASC NULLS LAST, quantity_on_hand ASC NULLS LAST, safety_stock ASC NULLS LAST) AS rn
  FROM (SELECT item_id, location_id, snapshot_date, quantity_on_hand, coalesce(safety_stock, 0.0) AS safety_stock, in_transit_qty,
               CASE WHEN load_ts >= TIMESTAMP '1997-01-01' THEN TIMESTAMP '{AS_OF}' ELSE TIMESTAMP '{EARLIER}' END AS load_ts,
               'inventory_system' AS source_system
        FROM fx_inventory WHERE quantity_on_hand >= 0 AND coalesce(safety_stock, 0) >= 0 AND in_transit_qty >= 0)) WHERE rn = 1""")
def _(t):
    feed = t.inventory_feed()
    raw = feed.select(*inv.SNAPSHOT, *inv.QUANTITIES, "load_ts")
    recent = F.col("load_ts") >= F.lit("1997-01-01").cast("timestamp_ntz")
    return _two_batches(t, "inventory", raw.withColumn("recent", recent).drop("load_ts"), ".csv")


@query("run_silver_supplier", using="fx_supplier_feed fx_crosswalk", check=f"""
WITH fed AS (
  SELECT f.natural_key, coalesce(x.business_key, 'SUPPLIER_erp_system_' || f.natural_key) AS business_key, upper(name) AS name, status,
         upper(region) AS region, attributes_json,
         CASE WHEN load_ts >= TIMESTAMP '1997-01-01' THEN TIMESTAMP '{AS_OF}' ELSE TIMESTAMP '{EARLIER}' END AS load_ts
  FROM fx_supplier_feed f LEFT JOIN fx_crosswalk x
    ON x.source_key = f.natural_key AND x.source_system = 'erp_system' AND x.entity_type = 'supplier' AND x.is_active
), one AS (
  SELECT * FROM fed QUALIFY row_number() OVER (PARTITION BY business_key, load_ts ORDER BY attributes_json NULLS LAST,
      name NULLS LAST, natural_key, region NULLS LAST, status NULLS LAST) = 1
), marked AS (
  SELECT *, lag(load_ts) OVER w IS NULL OR lag(name) OVER w IS DISTINCT FROM name OR lag(status) OVER w IS DISTINCT FROM status
            OR lag(region) OVER w IS DISTINCT FROM region OR lag(attributes_json) OVER w IS DISTINCT FROM attributes_json AS opens
  FROM one WINDOW w AS (PARTITION BY business_key ORDER BY load_ts)
)
SELECT natural_key, business_key, name, status, region, attributes_json, load_ts AS effective_start_ts,
       lead(load_ts) OVER v AS effective_end_ts, lead(load_ts) OVER v IS NULL AS is_current, 'erp_system' AS source_system, load_ts
FROM marked WHERE opens WINDOW v AS (PARTITION BY business_key ORDER BY load_ts)""")
def _(t):
    """Keys from the crosswalk, minted ones where it has none; the second batch lies before the first and rebuilds histories."""
    raw = t.supplier_feed().select(
        F.col("natural_key").alias("supplier_id"), F.col("name").alias("supplier_name"), "status", "region",
        F.col("attributes_json").alias("attributes"), "load_ts")
    recent = F.col("load_ts") >= F.lit("1997-01-01").cast("timestamp_ntz")
    return _two_batches(t, "supplier", raw.withColumn("recent", recent).drop("load_ts"), ".json",
                        crosswalk=t.crosswalk(), source_system="erp_system")


@query("run_gold", check=" UNION ALL ".join(f"""
SELECT '{name}' AS target, 1 AS version, count(*) AS n, CAST(round({total}, 3) AS DOUBLE) AS total FROM ({CHECKS[source]})"""
    for name, source, total in (
        ("unified_supply_chain", "unified_link", "count(DISTINCT shipment_id)"),
        ("supplier_performance", "supplier_performance", "sum(total_shipments * 100 + delivered_shipments)"),
        ("inventory_metrics", "inventory_metrics", "sum(total_inventory)"),
        ("shipment_performance", "shipment_performance", "sum(total_shipments * 100 + delayed_shipments)"))))
def _(t):
    """All gold tables behind the gate, put in force by one commit, and read from the store as it left them."""
    store = Store(t.spark, scratch_dir(t.spark, "lake"))
    parts = parts_of(t.lines().count(), SILVER_PARTS)
    orders = store.stage(t.shipment_orders(), "work.orders", [])  # every part of the shipments meets them
    if parts > 1:
        release(t.spark)
    moves = in_parts(t.shipment_feed(store.read_staged(orders)), ["shipment_id"], parts)
    silver = [store.stage([q.silver_shipments(t, part) for part in moves], SILVER["shipment"], [])]
    store.drop_staged(orders)
    stock = in_parts(t.inventory_feed(), inv.POSITION, parts)
    store.publish(*silver, *(store.stage(df, table, []) for table, df in (
        (SILVER["inventory"], [q.silver_inventory(t, part) for part in stock]), (SILVER["supplier"], q.supplier_dim(t)),
        (CROSSWALK, t.crosswalk()), (LINK, t.supply_link()))))
    if parts > 1:
        release(t.spark)
    Job(store, AS_OF).publish("all", None)
    totals = {
        "unified_supply_chain": F.count_distinct("shipment_id"), "inventory_metrics": F.sum("total_inventory"),
        "supplier_performance": F.sum(F.col("total_shipments") * 100 + F.col("delivered_shipments")),
        "shipment_performance": F.sum(F.col("total_shipments") * 100 + F.col("delayed_shipments"))}
    found = None
    for name in GOLD:
        row = store.read(f"gold.{name}").agg(F.count("*").alias("n"), F.round(totals[name], 3).cast("double").alias("total")).select(
            F.lit(name).alias("target"), F.lit(store.version(f"gold.{name}")).alias("version"), "n", "total")
        found = row if found is None else found.union(row)
    return found
