"""KPI tables over the unified table and the conformed tables.

Each metric is taken at its own grain: shipments once per shipment, stock once
per position. The ``*_literal`` forms aggregate the joined rows as they are,
where a position counts once per matching shipment.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stocktide.functions import labels
from stocktide.functions.timeexpr import hours_between, ts
from stocktide.operators import inventory as inv, scd2, shipments as shp, unified as uni

SUPPLIER = ["supplier_id", "supplier_name", "supplier_region"]


def _supplier_performance(moves: DataFrame, products: DataFrame, as_of: str) -> DataFrame:
    """From one row per (supplier, shipment) and one row per (supplier, product)."""
    both = moves.selectExpr(*SUPPLIER, "1 AS is_move", "delivered", "delay", "0 AS is_product").unionByName(
        products.selectExpr(*SUPPLIER, "0 AS is_move", "CAST(NULL AS BOOLEAN) AS delivered", "CAST(NULL AS INT) AS delay",
                            "1 AS is_product"))
    move = F.col("is_move") == 1
    punctual = move & F.col("delivered") & (F.col("delay") <= 0)
    return (
        both.groupBy(*SUPPLIER)
        .agg(
            F.sum("is_move").alias("total_shipments"),
            F.count_if(F.col("delivered")).alias("delivered_shipments"),
            F.avg(F.when(move, F.col("delivered").cast("double"))).alias("delivered_rate"),
            F.count_if(punctual).alias("on_time_deliveries"),
            F.avg(F.when(move, F.coalesce(punctual, F.lit(False)).cast("double"))).alias("on_time_rate"),
            F.avg("delay").alias("avg_delay_days"),
            F.sum("is_product").alias("total_products"),
        )
        .withColumns({
            "avg_inventory_turnover": F.lit(0.0),
            "performance_score": labels.performance_score(F.col("delivered_rate")),
            "last_updated": ts(as_of),
        })
    )


def supplier_performance(unified: DataFrame, as_of: str) -> DataFrame:
    """Per supplier: distinct shipments, delivered and on-time shares, mean delay, distinct products, score.

    Shipments and products are first made distinct (each a partial aggregate
    spread by its own id), then counted per supplier over the union of both.
    """
    known = unified.filter(F.col("supplier_id").isNotNull())
    moves = (
        known.filter(F.col("shipment_id").isNotNull())
        .groupBy(*SUPPLIER, "shipment_id")
        .agg(F.max("is_delivered").alias("delivered"), F.max("delivery_delay_days").alias("delay"))
    )
    return _supplier_performance(moves, known.select(*SUPPLIER, "product_id").distinct(), as_of)


def supplier_performance_direct(positions: DataFrame, shipments: DataFrame, as_of: str) -> DataFrame:
    """The same metrics from positions and shipments (one row per id), without building the unified rows."""
    arrival = F.col("actual_arrival_ts")
    moves = uni.shipments_in_reach(positions, shipments, SUPPLIER).select(
        *SUPPLIER, labels.delivered_flag(F.col("status"), arrival).alias("delivered"),
        labels.delay_days(F.col("planned_arrival_ts"), arrival).alias("delay"),
    )
    products = positions.filter(F.col("supplier_id").isNotNull()).select(*SUPPLIER, "product_id").distinct()
    return _supplier_performance(moves, products, as_of)


def supplier_performance_literal(unified: DataFrame, as_of: str) -> DataFrame:
    """Supplier metrics over the joined rows as they are; ``on_time`` counts delivered rows."""
    return (
        unified.filter(F.col("supplier_id").isNotNull())
        .groupBy(*SUPPLIER)
        .agg(
            F.count_distinct("shipment_id").alias("total_shipments"),
            F.count_if("is_delivered").alias("on_time_deliveries"),
            labels.share_where(F.col("is_delivered")).alias("on_time_rate"),
            F.avg("delivery_delay_days").alias("avg_delay_days"),
            F.count_distinct("product_id").alias("total_products"),
        )
        .withColumns({
            "avg_inventory_turnover": F.lit(0.0),
            "performance_score": labels.performance_score(F.col("on_time_rate")),
            "last_updated": ts(as_of),
        })
    )


def _stock_metrics(rows: DataFrame, as_of: str) -> DataFrame:
    return (
        rows.filter(F.col("product_id").isNotNull() & F.col("location_id").isNotNull())
        .groupBy("product_id", "location_id", "supplier_id")
        .agg(
            F.sum("quantity_on_hand").alias("total_inventory"),
            F.avg("safety_stock").alias("safety_stock_level"),
            F.max("inventory_date").alias("last_movement_date"),
        )
        .select(
            "product_id", "location_id", "supplier_id", "total_inventory", "safety_stock_level",
            labels.stock_label(F.col("total_inventory"), F.col("safety_stock_level")).alias("stockout_risk"),
            F.lit(0.0).alias("turnover_rate"), F.lit(0.0).alias("days_in_inventory"), "last_movement_date",
            ts(as_of).alias("last_updated"),
        )
    )


def inventory_metrics(unified: DataFrame, as_of: str) -> DataFrame:
    """Stock per (product, location, supplier), every position counted once."""
    grain = ["product_id", "location_id", "supplier_id", "item_id", "inventory_date"]
    once = unified.groupBy(*grain).agg(
        F.max("quantity_on_hand").alias("quantity_on_hand"), F.max("safety_stock").alias("safety_stock")
    )
    return _stock_metrics(once, as_of)


def inventory_metrics_literal(unified: DataFrame, as_of: str) -> DataFrame:
    """Stock metrics over the joined rows as they are."""
    return _stock_metrics(unified, as_of)


def shipment_performance(shipments: DataFrame, as_of: str) -> DataFrame:
    """Per carrier and route over the conformed shipments, cancelled ones included."""
    planned, actual = F.col("planned_arrival_ts"), F.col("actual_arrival_ts")
    delivered = labels.delivered_flag(F.col("status"), actual)
    delay = labels.delay_days(planned, actual)
    return (
        shipments.filter(F.col("carrier_id").isNotNull())
        .groupBy("carrier_id", "route_id")
        .agg(
            F.count("*").alias("total_shipments"),
            F.count_if(delivered).alias("delivered_shipments"),
            F.count_if(delay > 0).alias("delayed_shipments"),
            F.count_if(F.col("status") == "cancelled").alias("cancelled_shipments"),
            labels.share_where(delivered).alias("delivered_rate"),
            F.count_if(delivered & (delay <= 0)).alias("on_time_shipments"),
            labels.share_where(delivered & (delay <= 0)).alias("on_time_rate"),
            F.avg(delay).alias("avg_delay_days"),
            F.avg(hours_between(planned, actual)).alias("avg_delay_hours"),
            F.avg(F.datediff(F.coalesce(actual, planned), F.col("planned_departure_ts"))).alias("avg_transit_days"),
        )
        .withColumn("last_updated", ts(as_of))
    )


def shipment_performance_literal(unified: DataFrame, as_of: str) -> DataFrame:
    """Shipment metrics over the joined rows as they are; ``avg_delay_hours`` holds days."""
    transit = F.datediff(F.coalesce("actual_arrival_ts", "planned_arrival_ts"), F.col("planned_departure_ts"))
    return (
        unified.filter(F.col("carrier_id").isNotNull())
        .groupBy("carrier_id", "route_id")
        .agg(
            F.count("*").alias("total_shipments"),
            F.count_if("is_delivered").alias("on_time_shipments"),
            F.count_if(F.col("delivery_delay_days") > 0).alias("delayed_shipments"),
            F.count_if(F.col("shipment_status") == "cancelled").alias("cancelled_shipments"),
            labels.share_where(F.col("is_delivered")).alias("on_time_rate"),
            F.avg("delivery_delay_days").alias("avg_delay_hours"),
            F.avg(transit).alias("avg_transit_days"),
        )
        .withColumn("last_updated", ts(as_of))
    )


def supplier_ranking(performance: DataFrame) -> DataFrame:
    """Supplier summary, best score first."""
    return performance.select(
        "supplier_name", "supplier_region", "total_shipments", "on_time_deliveries", "on_time_rate",
        "avg_delay_days", "performance_score",
    ).orderBy(F.col("performance_score").desc(), "supplier_name")


def supplier_performance_crossed(
    inventory: DataFrame, suppliers: DataFrame, crosswalk: DataFrame, shipments: DataFrame, as_of: str,
    recent_days: int | None = 30,
) -> DataFrame:
    """Supplier metrics of the form in which every position is paired with every current supplier.

    That pairing has (positions x suppliers) rows before shipments are even
    joined. Its sums do not need the rows: a shipment is counted once per
    position dated within its fourteen-day reach, so day counts of the latest
    positions, weighted into day counts of each carrier's shipments, give the
    same numbers. Everything joined here is bounded by carriers x calendar days.
    """
    latest = inv.latest_with_ties(inventory).dropna(subset=["quantity_on_hand", "item_id", "location_id"])
    products = uni.all_mappings(crosswalk, "product", "item_id", "mapped_product")
    keyed = latest.select("item_id", F.col("snapshot_date").alias("day")).join(products, "item_id", "left")
    per_day = keyed.groupBy("day").agg(F.count("*").alias("positions"))
    all_positions = per_day.agg(F.sum("positions")).scalar()
    all_products = keyed.agg(F.count_distinct(F.coalesce("mapped_product", "item_id"))).scalar()

    moves = shp.recent_active(shipments, as_of, recent_days).filter("planned_departure_ts IS NOT NULL")
    arrival = F.col("actual_arrival_ts")
    daily = moves.select(
        "carrier_id", F.expr(uni.FIRST_DAY).alias("a"), F.expr(uni.LAST_DAY).alias("b"),
        labels.delivered_flag(F.col("status"), arrival).alias("delivered"),
        labels.delay_days(F.col("planned_arrival_ts"), arrival).alias("delay"),
    ).groupBy("carrier_id", "a", "b").agg(
        F.count("*").alias("moves"), F.count_if("delivered").alias("delivered"),
        F.sum("delay").alias("delay_sum"), F.count("delay").alias("delay_count"),
    )
    weighted = (
        daily.withColumn("day", F.explode(F.sequence("a", "b"))).join(per_day, "day")
        .groupBy("carrier_id", "a", "b", "moves", "delivered", "delay_sum", "delay_count")
        .agg(F.sum("positions").alias("w"))
        .groupBy("carrier_id")
        .agg(
            F.sum("moves").alias("shipments"), F.sum(F.expr("moves * w")).alias("pairs"),
            F.sum(F.expr("delivered * w")).alias("delivered_pairs"), F.sum(F.expr("delay_sum * w")).alias("delay_sum"),
            F.sum(F.expr("delay_count * w")).alias("delay_count"),
        )
    )
    reached = (
        uni.covered_days(moves).withColumn("day", F.explode(F.sequence("from_day", "to_day"))).join(per_day, "day")
        .groupBy("carrier_id").agg(F.sum("positions").alias("reached"))
    )
    per_carrier = weighted.join(reached, "carrier_id")
    current = scd2.current_projection(suppliers).join(
        uni.all_mappings(crosswalk, "supplier", "supplier_id", "mapped_supplier"), "supplier_id", "left")
    none = F.lit(0)
    return (
        current.join(per_carrier, F.col("mapped_supplier") == F.col("carrier_id"), "left")
        .withColumns({
            "supplier_id": F.coalesce("mapped_supplier", "supplier_id"),
            "rows": F.coalesce("pairs", none) + all_positions - F.coalesce("reached", none),
        })
        .groupBy(*SUPPLIER)
        .agg(
            F.coalesce(F.max("shipments"), none).alias("total_shipments"),
            F.coalesce(F.sum("delivered_pairs"), none).alias("on_time_deliveries"),
            (F.coalesce(F.sum("delivered_pairs"), none) / F.sum("rows")).alias("on_time_rate"),
            F.try_divide(F.sum("delay_sum"), F.sum("delay_count")).alias("avg_delay_days"),
            F.sum("rows").alias("joined_rows"),
        )
        .withColumns({
            "total_products": all_products,
            "avg_inventory_turnover": F.lit(0.0),
            "performance_score": labels.performance_score(F.col("on_time_rate")),
            "last_updated": ts(as_of),
        })
    )
