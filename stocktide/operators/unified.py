"""The unified supply-chain table: inventory, suppliers and shipments side by side."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stocktide.functions import labels
from stocktide.functions.timeexpr import plus_days, ts
from stocktide.operators import crosswalk as xw
from stocktide.operators import inventory as inv
from stocktide.operators import scd2, shipments as shp

WINDOW_DAYS = 7
SHIPMENT_COLUMNS = [
    "shipment_id", "route_id", "carrier_id", "origin", "destination", "planned_departure_ts", "actual_departure_ts",
    "planned_arrival_ts", "actual_arrival_ts", "shipment_status", "shipment_source", "shipment_load_ts",
]


# Days of inventory a departure reaches: a departure after midnight misses the day seven days before it.
FIRST_DAY = ("date_add(to_date(planned_departure_ts), IF(planned_departure_ts > date_trunc('day', planned_departure_ts), "
             f"1, 0) - {WINDOW_DAYS})")
LAST_DAY = f"date_add(to_date(planned_departure_ts), {WINDOW_DAYS})"


def all_mappings(crosswalk: DataFrame, entity_type: str, natural: str, business: str) -> DataFrame:
    """Every mapping of an entity, active or not, as natural key and business key."""
    rows = crosswalk.filter(F.col("entity_type") == entity_type)
    return rows.select(F.col("source_key").alias(natural), F.col("business_key").alias(business))


def _entity_mappings(crosswalk: DataFrame, entity_type: str, natural: str, business: str) -> DataFrame:
    """One business key per natural key of an entity, over all source systems."""
    best = xw.best_mappings(crosswalk.filter(F.col("entity_type") == entity_type), ["source_key", "entity_type"])
    return best.select(F.col("source_key").alias(natural), F.col("business_key").alias(business))


def positions(
    inventory: DataFrame, suppliers: DataFrame, crosswalk: DataFrame, link: DataFrame, keep_ties: bool = False
) -> DataFrame:
    """Latest inventory positions with product key and current supplier; one row per position.

    ``link`` names the supplier of each (item, location); of several rows for one the smallest supplier counts. Positions
    without a link or supplier are kept with NULL supplier columns.
    """
    newest = inv.latest_with_ties(inventory) if keep_ties else inv.latest(inventory)
    newest = newest.dropna(subset=["quantity_on_hand", "item_id", "location_id"]).select(
        "item_id", "location_id", F.col("snapshot_date").alias("inventory_date"), *inv.QUANTITIES,
        F.col("source_system").alias("inventory_source"), F.col("load_ts").alias("inventory_load_ts"),
    )
    supplier = (
        scd2.current_projection(suppliers).drop("supplier_effective_start")
        .join(_entity_mappings(crosswalk, "supplier", "supplier_id", "mapped_supplier"), "supplier_id", "left")
    )
    products = _entity_mappings(crosswalk, "product", "item_id", "mapped_product")
    return (
        newest.join(link.groupBy(*inv.POSITION).agg(F.min("supplier_id").alias("supplier_id")), inv.POSITION, "left")
        .join(products, "item_id", "left")
        .join(supplier, "supplier_id", "left")
        .withColumns({
            "product_id": F.coalesce("mapped_product", "item_id"),
            "supplier_id": F.coalesce("mapped_supplier", F.when(F.col("supplier_name").isNotNull(), F.col("supplier_id"))),
        })
        .drop("mapped_product", "mapped_supplier")
    )


def _bucket(day: Column) -> Column:
    return F.floor(F.datediff(day, F.lit("1970-01-01").cast("date")) / WINDOW_DAYS)


def attach_shipments(base: DataFrame, shipments: DataFrame) -> DataFrame:
    """Left join of positions with their supplier's shipments planned within seven days of the snapshot.

    The join key is (supplier, week), each position standing in its own week and
    the two beside it, so one busy supplier spreads over many keys and only near
    pairs are compared. Positions without any such shipment are added by an anti
    join; both joins let adaptive execution split what skew is left.
    """
    moves = shipments.select(
        *[c for c in SHIPMENT_COLUMNS if c in shipments.columns],
        F.col("status").alias("shipment_status"), F.col("source_system").alias("shipment_source"),
        F.col("load_ts").alias("shipment_load_ts"),
    ).withColumn("_week", _bucket(F.col("planned_departure_ts")))
    week = _bucket(F.col("inventory_date"))
    spread = base.withColumn("_week", F.explode(F.array(week - 1, week, week + 1)))
    snapshot = ts(F.col("inventory_date"))
    near = (
        (spread["supplier_id"] == moves["carrier_id"])
        & (spread["_week"] == moves["_week"])
        & (F.col("planned_departure_ts") >= plus_days(snapshot, -WINDOW_DAYS))
        & (F.col("planned_departure_ts") <= plus_days(snapshot, WINDOW_DAYS))
    )
    matched = spread.join(moves, near).drop("_week")

    covered = covered_days(moves)
    within = (
        (base["supplier_id"] == covered["carrier_id"])
        & (base["inventory_date"] >= covered["from_day"])
        & (base["inventory_date"] <= covered["to_day"])
    )
    unmatched = base.join(covered, within, "left_anti")
    return matched.unionByName(unmatched, allowMissingColumns=True)


def merged_ranges(ranges: DataFrame, keys: list[str], start: str, end: str, slack: int = 0) -> DataFrame:
    """Distinct ranges per key with overlapping ones joined; ``slack`` days between ranges still join them.

    Meant for ranges that begin on days: their distinct number per key is
    bounded by the calendar, whatever number of rows they come from.
    """
    by_start = Window.partitionBy(*keys).orderBy(start, end)
    reached = F.max(end).over(by_start.rowsBetween(Window.unboundedPreceding, -1))
    return (
        ranges.select(*keys, start, end).distinct()
        .withColumn("_gap", F.when(F.col(start) <= F.date_add(reached, slack), 0).otherwise(1))
        .withColumn("_run", F.sum("_gap").over(by_start))
        .groupBy(*keys, "_run")
        .agg(F.min(start).alias(start), F.max(end).alias(end))
        .drop("_run")
    )


def covered_days(shipments: DataFrame) -> DataFrame:
    """Per carrier, the closed day ranges in which a snapshot has a shipment within seven days."""
    reach = shipments.filter("planned_departure_ts IS NOT NULL").selectExpr(
        "carrier_id", f"{FIRST_DAY} AS from_day", f"{LAST_DAY} AS to_day")
    return merged_ranges(reach, ["carrier_id"], "from_day", "to_day", slack=1)


def shipments_in_reach(base: DataFrame, shipments: DataFrame, keys: list[str]) -> DataFrame:
    """Shipments that the unified table joins to at least one position, once per combination of ``keys``.

    Equal to the distinct (keys, shipment) of the joined rows, without joining
    row by row: the positions of a supplier collapse into few time ranges.
    """
    reach = base.filter("supplier_id IS NOT NULL").selectExpr(
        *keys, f"date_sub(inventory_date, {WINDOW_DAYS}) AS from_day", f"date_add(inventory_date, {WINDOW_DAYS}) AS to_day")
    ranges = merged_ranges(reach, keys, "from_day", "to_day")
    near = F.expr("carrier_id = supplier_id AND planned_departure_ts >= CAST(from_day AS TIMESTAMP_NTZ) "
                  "AND planned_departure_ts <= CAST(to_day AS TIMESTAMP_NTZ)")
    return shipments.join(ranges, near).drop("from_day", "to_day")


def finish(joined: DataFrame, as_of: str) -> DataFrame:
    """Derived columns and final column order."""
    long_ago = ts("1900-01-01")
    return joined.withColumns({
        "stock_status": labels.stock_label_safety_first(F.col("quantity_on_hand"), F.col("safety_stock")),
        "delivery_delay_days": labels.delay_days(F.col("planned_arrival_ts"), F.col("actual_arrival_ts")),
        "is_delivered": labels.delivered_flag(F.col("shipment_status"), F.col("actual_arrival_ts")),
        "view_created_ts": ts(as_of),
        "last_data_update_ts": F.greatest(F.coalesce("inventory_load_ts", long_ago),
                                          F.coalesce("shipment_load_ts", long_ago)),
    }).select(
        "product_id", "location_id", "supplier_id", "supplier_name", "supplier_status", "supplier_region",
        "supplier_attributes", *inv.QUANTITIES, "inventory_date", *SHIPMENT_COLUMNS[:10], "inventory_source",
        "supplier_source", "shipment_source", "inventory_load_ts", "shipment_load_ts", "stock_status",
        "delivery_delay_days", "is_delivered", "view_created_ts", "last_data_update_ts", "item_id",
    )


def build(
    inventory: DataFrame, suppliers: DataFrame, crosswalk: DataFrame, shipments: DataFrame, link: DataFrame,
    as_of: str, recent_days: int | None = 30, keep_ties: bool = False,
) -> DataFrame:
    """The wide table. ``recent_days=None`` joins the whole shipment history."""
    base = positions(inventory, suppliers, crosswalk, link, keep_ties)
    return finish(attach_shipments(base, shp.recent_active(shipments, as_of, recent_days)), as_of)


def by_days(base: DataFrame, shipments: DataFrame, parts: int) -> list[tuple[DataFrame, DataFrame]]:
    """Positions dealt to ranges of days, each with all shipments within reach of its days: attached range by range, the rows
    are those attached at once.

    Ranges are cut from counts per day, a position weighing as much as four shipments: it stands in three weeks and leads to
    the widest rows. Positions without a day are in the first range.
    """
    if parts == 1:
        return [(base, shipments)]
    counts = base.groupBy(F.unix_date("inventory_date").alias("day")).agg((4 * F.count("*")).alias("n")).unionByName(
        shipments.groupBy(F.unix_date(F.to_date("planned_departure_ts")).alias("day")).agg(F.count("*").alias("n")))
    found = counts.agg(F.percentile("day", [i / parts for i in range(1, parts)], F.col("n"))).first()[0] or []
    cuts = sorted({math.floor(c) for c in found})

    def day(number: int) -> Column:
        return F.date_from_unix_date(F.lit(number))

    ranges = []
    for after, last in zip([None, *cuts], [*cuts, None]):
        mine, near = base, shipments
        if after is not None:
            mine = mine.filter(F.col("inventory_date") > day(after))
            near = near.filter(F.col("planned_departure_ts") >= ts(day(after + 1 - WINDOW_DAYS)))
        if last is not None:
            within = F.col("inventory_date") <= day(last)
            mine = mine.filter(within | F.col("inventory_date").isNull() if after is None else within)
            near = near.filter(F.col("planned_departure_ts") < ts(day(last + 1 + WINDOW_DAYS)))
        ranges.append((mine, near))
    return ranges


def region_recent(unified: DataFrame, region: str, as_of: str, days: int = 7) -> DataFrame:
    """Rows of one supplier region with inventory dated in the last ``days`` days."""
    return (
        unified.filter(
            (F.col("supplier_region") == region)
            & (F.col("inventory_date") >= F.date_sub(F.lit(as_of).cast("date"), days))
        )
        .select("product_id", "location_id", "supplier_name", "supplier_region", "quantity_on_hand", "safety_stock",
                "stock_status", "shipment_status", "delivery_delay_days", "last_data_update_ts")
        .orderBy("product_id", "location_id")
    )


def stockout_report(unified: DataFrame) -> DataFrame:
    """Rows at risk or out of stock with a risk level, most urgent label first."""
    return (
        unified.filter(F.col("stock_status").isin("at_risk", "stockout"))
        .select("product_id", "location_id", "supplier_name", "quantity_on_hand", "safety_stock", "stock_status",
                labels.stock_label(F.col("quantity_on_hand"), F.col("safety_stock"), labels.RISK_UPPER)
                .alias("risk_level"))
        .orderBy("risk_level", "quantity_on_hand")
    )


def latest_updates(unified: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` most recently updated rows; ties by keys."""
    return unified.orderBy(
        F.col("last_data_update_ts").desc(), "product_id", "location_id", "supplier_id", "shipment_id"
    ).limit(n)


def records(unified: DataFrame, start: str, end: str, page_rows: int | None = None) -> DataFrame:
    """Unified records with nested shipments for inventory dated in [start, end): one per key.

    With ``page_rows`` a record comes in pages of about so many shipments (a ``page`` column numbers them), so that no array
    grows with the busiest supplier; shipments are dealt to pages by a hash of their id. A reader concatenates the pages.
    """
    window = (ts(F.col("inventory_date")) >= ts(start)) & (ts(F.col("inventory_date")) < ts(end))
    key = ["product_id", "location_id", "supplier_id", "item_id", "inventory_date", *inv.QUANTITIES]
    shipment = F.struct(
        "shipment_id", "route_id", "carrier_id",
        F.col("planned_departure_ts").alias("planned_departure"),
        F.col("actual_departure_ts").alias("actual_departure"),
        F.col("planned_arrival_ts").alias("planned_arrival"),
        F.col("actual_arrival_ts").alias("actual_arrival"),
        F.col("shipment_status").alias("status"),
    )
    rows, page = unified.filter(window), []
    if page_rows:
        null_safe = [F.col(f"_{c}").eqNullSafe(F.col(c)) for c in key]
        sizes = rows.groupBy(*(F.col(c).alias(f"_{c}") for c in key)).agg(F.ceil(F.count("shipment_id") / page_rows).alias("_pages"))
        rows = rows.join(sizes, null_safe).withColumn(
            "page", F.coalesce(F.pmod(F.xxhash64("shipment_id"), F.greatest("_pages", F.lit(1))), F.lit(0)))
        page = ["page"]
    grouped = rows.groupBy(*key, *page).agg(
        F.sort_array(F.collect_list(F.when(F.col("shipment_id").isNotNull(), shipment))).alias("shipments"))
    inventory = F.struct("item_id", "location_id", F.col("inventory_date").alias("snapshot_date"), *inv.QUANTITIES)
    return grouped.select("product_id", "location_id", "supplier_id", *page, "shipments", inventory.alias("inventory"))


def register_view(unified: DataFrame, name: str = "unified_supply_chain") -> None:
    unified.createOrReplaceTempView(name)
