"""Registered queries that go through files and streams."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from stocktide import schemas
from stocktide.operators import inventory as inv, scd2
from stocktide.plans.ctes import AS_OF
from stocktide.plans.registry import query
from stocktide.session import scratch_dir
from stocktide.sources.clustered import ClusteredTable
from stocktide.sources.readers import load, open_envelope, read_envelope, typed
from stocktide.sources.store import Store
from stocktide.streaming import streams

# --- file sources and stores --------------------------------------------------------------------------------


@query("ingest_csv", using="fx_shipment_text", check=f"""
SELECT shipment_id, route_id, carrier_id, origin, destination,
       TRY_CAST(planned_departure AS TIMESTAMP) AS planned_departure, CAST(NULL AS TIMESTAMP) AS actual_departure,
       CAST(planned_arrival AS TIMESTAMP) AS planned_arrival, CAST(NULL AS TIMESTAMP) AS actual_arrival, status,
       CAST(NULL AS VARCHAR) AS tracking_number, TRY_CAST(weight AS DOUBLE) AS weight, TRY_CAST(volume AS DOUBLE) AS volume,
       TIMESTAMP '{AS_OF}' AS _ingestion_ts, 'logistics_system' AS _source_system FROM fx_shipment_text""")
def _(t):
    """Raw shipments through CSV files: header row, text columns, tolerant typing."""
    path = scratch_dir(t.spark, "shipments") + ".csv"
    t.shipment_text().write.option("header", True).csv(path)
    return typed(load(t.spark, "shipment", path, AS_OF), "shipment").drop("_source_file")


@query("ingest_json", using="fx_inventory", check=f"""
SELECT item_id, location_id, snapshot_date, quantity_on_hand, safety_stock, in_transit_qty,
       TIMESTAMP '{AS_OF}' AS _ingestion_ts, 'inventory_system' AS _source_system FROM fx_inventory""")
def _(t):
    """Inventory through JSON lines."""
    path = scratch_dir(t.spark, "inventory") + ".json"
    t.inventory_feed().select(*inv.SNAPSHOT, *inv.QUANTITIES).write.json(path)
    return typed(load(t.spark, "inventory", path, AS_OF), "inventory").select(
        *inv.SNAPSHOT, *inv.QUANTITIES, "_ingestion_ts", "_source_system")


@query("ingest_parquet", using="fx_supplier_feed", check=f"""
SELECT natural_key, business_key, upper(name) AS name, status, region, attributes_json, 'supplier_system' AS source_system,
       TIMESTAMP '{AS_OF}' AS load_ts FROM fx_supplier_feed""")
def _(t):
    """Suppliers through parquet files, typed and conformed."""
    path = scratch_dir(t.spark, "suppliers") + ".parquet"
    t.supplier_feed().select(
        F.col("natural_key").alias("supplier_id"), F.col("name").alias("supplier_name"), "status", "region",
        F.col("attributes_json").alias("attributes"),
    ).write.parquet(path)
    return scd2.conform(typed(load(t.spark, "supplier", path, AS_OF), "supplier"))


@query("ingest_envelope", using="fx_supplier_feed", check=f"""
SELECT natural_key AS key, 'erp_system' AS source_system, TIMESTAMP '{AS_OF}' AS load_ts, natural_key AS supplier_id,
       name AS supplier_name, status, region FROM fx_supplier_feed""")
def _(t):
    """Suppliers landed as one string per line, then opened by schema."""
    path = scratch_dir(t.spark, "envelope")
    t.supplier_feed().select(
        F.col("natural_key").alias("supplier_id"), F.col("name").alias("supplier_name"), "status", "region",
    ).write.json(path)
    landed = read_envelope(t.spark, path, "supplier_id", "erp_system", AS_OF)
    return open_envelope(landed, schemas.SUPPLIER_RAW).select(
        "key", "source_system", "load_ts", "supplier_id", "supplier_name", "status", "region")


@query("store_append", using="fx_inventory", check="""
SELECT source_system, count(*) AS rows, count(checked_by) AS checked_rows FROM (
  SELECT source_system, NULL AS checked_by FROM fx_inventory
  UNION ALL SELECT source_system, 'audit' FROM fx_inventory WHERE quantity_on_hand < 0) GROUP BY 1""")
def _(t):
    """Two appends, the second with a new column; readers see the union of both schemas."""
    store = Store(t.spark, scratch_dir(t.spark, "append"))
    feed = t.inventory_feed()
    store.append(feed, "bronze.snapshots", ["source_system"])
    store.append(feed.filter("quantity_on_hand < 0").withColumn("checked_by", F.lit("audit")), "bronze.snapshots",
                 ["source_system"])
    return store.read_appended("bronze.snapshots").groupBy("source_system").agg(
        F.count("*").alias("rows"), F.count("checked_by").alias("checked_rows"))


@query("store_replace", using="clean_inventory", check="""
SELECT location_id, count(*) AS rows, CAST(2 AS INT) AS version FROM clean_inventory WHERE quantity_on_hand > 0 GROUP BY 1""")
def _(t):
    """A table replaced by a filter of itself: readers move to version 2."""
    store = Store(t.spark, scratch_dir(t.spark, "replace"))
    store.replace(inv.clean(t.inventory_feed(), AS_OF), "silver.snapshots", ["location_id"])
    version = store.replace(store.read("silver.snapshots").filter("quantity_on_hand > 0"), "silver.snapshots",
                            ["location_id"])
    return store.read("silver.snapshots").groupBy("location_id").agg(
        F.count("*").alias("rows"), F.lit(version).alias("version"))


# --- streams ------------------------------------------------------------------------------------------------


def _events(t):
    return streams.file_stream(t.spark, t.sf_dir, t.raw("events").schema, name_glob="events.parquet")


def _finished(t, stream, purpose: str):
    out = scratch_dir(t.spark, purpose)
    streams.run_to_files(stream, f"{out}/data", f"{out}/checkpoint")
    return t.spark.read.schema(stream.schema).parquet(f"{out}/data")


@query("stream_ingest", check="SELECT event_id, ts, user_id, event_type, value, props FROM events")
def _(t):
    return _finished(t, _events(t), "stream-ingest")


@query("stream_window_counts", check="""
SELECT window_start, window_end, event_type, events, sum_value FROM (
  SELECT date_trunc('hour', ts) AS window_start, date_trunc('hour', ts) + INTERVAL 1 HOUR AS window_end, event_type,
         count(*) AS events, round(sum(value), 4) AS sum_value FROM events GROUP BY 1, 2, 3)
WHERE window_end <= (SELECT max(ts) - INTERVAL 10 MINUTE FROM events)""")
def _(t):
    """Hourly counts; a window is written once the watermark has passed its end."""
    counts = streams.tumbling_counts(_events(t), "ts", ["event_type"], "1 hour", "10 minutes", value="value")
    return _finished(t, counts, "stream-windows").withColumn("sum_value", F.round("sum_value", 4))


@query("stream_sliding_counts", check="""
SELECT window_start, window_end, event_type, count(*) AS events FROM (
  SELECT date_trunc('hour', ts) - INTERVAL 1 HOUR * k AS window_start,
         date_trunc('hour', ts) - INTERVAL 1 HOUR * k + INTERVAL 2 HOUR AS window_end, event_type
  FROM events, (SELECT 0 AS k UNION ALL SELECT 1))
WHERE window_end <= (SELECT max(ts) - INTERVAL 10 MINUTE FROM events) GROUP BY 1, 2, 3""")
def _(t):
    """Two-hour windows every hour."""
    counts = streams.tumbling_counts(_events(t), "ts", ["event_type"], "2 hours", "10 minutes", slide="1 hour")
    return _finished(t, counts, "stream-sliding")


@query("stream_session_counts", check="""
SELECT session_start, session_end, user_id, events FROM (
  SELECT user_id, min(ts) AS session_start, max(ts) + INTERVAL 12 HOUR AS session_end, count(*) AS events
  FROM (SELECT *, sum(opens) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS session FROM (
          SELECT *, CASE WHEN ts < lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) + INTERVAL 12 HOUR
                         THEN 0 ELSE 1 END AS opens FROM events))
  GROUP BY user_id, session)
WHERE session_end <= (SELECT max(ts) - INTERVAL 10 MINUTE FROM events)""")
def _(t):
    """Sessions per user, closed after twelve quiet hours."""
    counts = streams.session_counts(_events(t), "ts", ["user_id"], "12 hours", "10 minutes")
    return _finished(t, counts, "stream-sessions")


@query("stream_dedupe", check="SELECT DISTINCT user_id, event_type, date_trunc('hour', ts) AS hour FROM events")
def _(t):
    """Repeats of a user's event type within an hour are dropped."""
    keyed = _events(t).withColumn("hour", F.date_trunc("hour", "ts").cast("timestamp_ntz"))
    kept = streams.without_repeats(keyed, "ts", ["user_id", "event_type", "hour"], "1 hour")
    return _finished(t, kept, "stream-dedupe").select("user_id", "event_type", "hour")


@query("stream_upsert", using="silver_inventory", check="SELECT * FROM silver_inventory")
def _(t):
    """Inventory snapshots streamed from line items: equal to the batch upsert."""
    lines = streams.file_stream(t.spark, t.sf_dir, t.raw("lineitem").schema, name_glob="lineitem.parquet")
    out = scratch_dir(t.spark, "stream-upsert")
    sink = streams.UpsertSink(
        t.spark, f"{out}/data", inv.SNAPSHOT, [F.col("load_ts").desc_nulls_last()],
        prepare=lambda batch: inv.clean(t.inventory_feed(batch), AS_OF))
    sink.run(lines, f"{out}/checkpoint")
    return sink.read()


@query("stream_late_rows", check="""
WITH e AS (SELECT event_id, ts, event_id % 4 AS batch FROM events), m AS (SELECT batch, max(ts) AS latest FROM e GROUP BY batch)
SELECT event_id, ts, batch AS batch_id,
       coalesce(ts < (SELECT max(latest) FROM m WHERE m.batch < e.batch) - INTERVAL 7 DAY, false) AS late FROM e""")
def _(t):
    """Four micro-batches of events; rows a week behind what came before are set apart, none is lost."""
    events, source, out = t.raw("events").select("event_id", "ts"), scratch_dir(t.spark, "events"), scratch_dir(t.spark, "late-split")
    split = streams.LateSplit(t.spark, out, "ts", "7 days")
    for batch in range(4):
        events.where(F.col("event_id") % 4 == batch).coalesce(1).write.mode("append").parquet(source)
        split.run(streams.file_stream(t.spark, source, events.schema), f"{out}/checkpoint")
    columns = ["event_id", "ts", F.col("batch_id").cast("bigint").alias("batch_id")]
    return split.on_time().select(*columns, F.lit(False).alias("late")).union(split.late().select(*columns, F.lit(True).alias("late")))


_LAYOUT = ["snapshot_date", "quantity_on_hand"]
#: Rows of a small file, at most: appends of a larger feed leave more of them.
SMALL_FILE_ROWS = 1 << 18


def _clustered(t, files: int = 16) -> ClusteredTable:
    table = ClusteredTable(Store(t.spark, scratch_dir(t.spark, "clustered")), "silver.snapshots", _LAYOUT)
    table.append(t.inventory_feed().drop("load_ts"), files)
    return table


@query("z_order_filter", using="fx_inventory", check="""
SELECT item_id, location_id, snapshot_date, quantity_on_hand, safety_stock, in_transit_qty, source_system, true AS skipped FROM fx_inventory
WHERE snapshot_date BETWEEN DATE '1995-01-01' AND DATE '1995-06-30' AND quantity_on_hand BETWEEN 5 AND 12""")
def _(t):
    """A filter on two columns of a table along the curve; ``skipped``: at most half of its files were opened."""
    table = _clustered(t)
    ranges = {"snapshot_date": (dt.date(1995, 1, 1), dt.date(1995, 6, 30)), "quantity_on_hand": (5.0, 12.0)}
    return table.read(ranges).withColumn("skipped", F.lit(2 * len(table.matching(ranges)) <= len(table.files())))


@query("pack_small_files", using="fx_inventory", check="""
SELECT location_id, count(*) AS n, sum(quantity_on_hand) AS quantity, true AS fewer FROM fx_inventory GROUP BY location_id""")
def _(t):
    """Appends of small files, rewritten together: fewer files, the same rows."""
    table = ClusteredTable(Store(t.spark, scratch_dir(t.spark, "packed")), "silver.snapshots", _LAYOUT)
    feed = t.inventory_feed().drop("load_ts")
    for k in range(4):
        table.append(feed.where(F.pmod(F.xxhash64("item_id"), F.lit(4)) == k), 4, SMALL_FILE_ROWS)
    before = len(table.files())
    table.pack(partitions=2)
    return table.read().groupBy("location_id").agg(F.count("*").alias("n"), F.sum("quantity_on_hand").alias("quantity")).withColumn(
        "fewer", F.lit(len(table.files()) < before))


@query("retention_job", using="fx_inventory", check="""
SELECT CAST(date_part('year', snapshot_date) AS INT) AS year, count(*) AS n, true AS untouched FROM fx_inventory
WHERE snapshot_date >= DATE '1998-03-17' GROUP BY ALL""")
def _(t):
    """Rows before an instant go: files of older rows unread, later files untouched, only mixed ones rewritten."""
    table = _clustered(t, 24)
    before = {f["path"]: f["ranges"]["snapshot_date"] for f in table.files()}
    done = table.expire(dt.date(1998, 3, 17), "snapshot_date")
    after = {f["path"] for f in table.files()}
    late = {p for p, (least, _, nulls) in before.items() if least is not None and least >= "1998-03-17"}
    return table.read().groupBy(F.year("snapshot_date").alias("year")).agg(F.count("*").alias("n")).withColumn(
        "untouched", F.lit(late <= after and done["dropped"] > 0))
