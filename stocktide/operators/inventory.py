"""Inventory conformance, snapshots and stock metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stocktide.functions import labels
from stocktide.functions.timeexpr import ts
from stocktide.operators.common import first_per_key, merge_latest, require_columns, with_missing

QUANTITIES = ["quantity_on_hand", "safety_stock", "in_transit_qty"]
REQUIRED = ["item_id", "location_id", "snapshot_date", *QUANTITIES, "source_system"]
POSITION = ["item_id", "location_id"]
SNAPSHOT = ["item_id", "location_id", "snapshot_date"]


def conform(raw: DataFrame) -> DataFrame:
    """Bronze layout to silver layout; missing safety stock and in-transit quantities are zero."""
    zero = F.lit(0.0)
    return raw.select(
        "item_id", "location_id", "snapshot_date", "quantity_on_hand",
        F.coalesce("safety_stock", zero).alias("safety_stock"),
        F.coalesce("in_transit_qty", zero).alias("in_transit_qty"),
        F.col("_source_system").alias("source_system"),
        F.col("_ingestion_ts").alias("load_ts"),
    )


def clean(df: DataFrame, as_of: str | None = None) -> DataFrame:
    """Negative and missing quantities become zero."""
    require_columns(df, REQUIRED, "inventory")
    df = with_missing(df, load_ts=ts(as_of) if as_of else F.current_timestamp().cast("timestamp_ntz"))
    zero = F.lit(0.0)
    return df.withColumns({c: F.greatest(F.coalesce(F.col(c), zero), zero) for c in QUANTITIES})


def newest(incoming: DataFrame, as_of: str | None = None) -> DataFrame:
    """The rows that a batch puts in force: cleaned, the latest load per (item, location, date)."""
    return first_per_key(clean(incoming, as_of), SNAPSHOT, [F.col("load_ts").desc_nulls_last()])


def upsert(existing: DataFrame, incoming: DataFrame, as_of: str | None = None) -> DataFrame:
    """Clean the incoming rows and keep the latest load per (item, location, date)."""
    return merge_latest(existing, clean(incoming, as_of), SNAPSHOT, [F.col("load_ts").desc_nulls_last()])


def latest(df: DataFrame, item_id: str | None = None, location_id: str | None = None) -> DataFrame:
    """One row per (item, location): the latest snapshot, then the latest load, then all columns."""
    if item_id:
        df = df.filter(F.col("item_id") == item_id)
    if location_id:
        df = df.filter(F.col("location_id") == location_id)
    order = [F.col("snapshot_date").desc_nulls_last(), F.col("load_ts").desc_nulls_last(),
             F.col("source_system").asc_nulls_last()]
    return first_per_key(df, POSITION, order)


def latest_with_ties(df: DataFrame) -> DataFrame:
    """Every row of the latest snapshot date of its (item, location).

    Aggregate and join back rather than a window, so that a position with very
    many rows is reduced before the shuffle.
    """
    newest = df.groupBy(*POSITION).agg(F.max("snapshot_date").alias("snapshot_date"))
    return df.join(newest, SNAPSHOT, "left_semi")


def on_date(df: DataFrame, day: str) -> DataFrame:
    return df.filter(F.col("snapshot_date") == F.lit(day).cast("date"))


def _since(df: DataFrame, as_of: str, days: int) -> DataFrame:
    return df.filter(F.col("snapshot_date") >= F.date_sub(F.lit(as_of).cast("date"), days))


def history(df: DataFrame, item_id: str, location_id: str, as_of: str, days: int = 30) -> DataFrame:
    """Snapshots of one position over the last ``days`` days."""
    found = df.filter((F.col("item_id") == item_id) & (F.col("location_id") == location_id))
    return _since(found, as_of, days).orderBy("snapshot_date")


def stockout_risk(df: DataFrame) -> DataFrame:
    """Latest positions at or below safety stock, or empty, with the risk label."""
    quantity, safety = F.col("quantity_on_hand"), F.col("safety_stock")
    return (
        latest(df)
        .filter((quantity <= safety) | (quantity == 0))
        .withColumn("stockout_risk", labels.stock_label(quantity, safety, labels.RISK_LOWER))
    )


def location_metrics(df: DataFrame) -> DataFrame:
    """Latest positions summed per location."""
    risk = labels.stock_label(F.col("quantity_on_hand"), F.col("safety_stock"))
    return (
        latest(df)
        .select("location_id", "item_id", *QUANTITIES, risk.alias("risk"))
        .groupBy("location_id")
        .agg(
            F.count("item_id").alias("total_items"),
            F.sum("quantity_on_hand").alias("total_on_hand"),
            F.sum("safety_stock").alias("total_safety_stock"),
            F.sum("in_transit_qty").alias("total_in_transit"),
            F.count("risk").alias("risk_labelled_items"),
            F.count_if(F.col("risk") == "stockout").alias("stockout_items"),
            F.count_if(F.col("risk") == "at_risk").alias("at_risk_items"),
            F.count_if(F.col("risk") == "healthy").alias("healthy_items"),
        )
    )


def coverage_ratio(metrics: DataFrame) -> DataFrame:
    """On-hand stock over safety stock per location, from ``location_metrics``; NULL without safety stock."""
    return metrics.select(
        "location_id", "total_items", "total_on_hand", "total_safety_stock", "total_in_transit",
        F.round(F.try_divide("total_on_hand", "total_safety_stock"), 2).alias("coverage_ratio"),
    )


def turnover(df: DataFrame, as_of: str, days: int = 30) -> DataFrame:
    """Turnover of every position over the last ``days`` days.

    Fewer than two snapshots give zero rates and no average.
    """
    grouped = _since(df, as_of, days).groupBy(*POSITION).agg(
        F.count("*").alias("snapshots"), F.avg("quantity_on_hand").alias("mean_qty")
    )
    enough = F.col("snapshots") >= 2
    rate = F.when(enough & (F.col("mean_qty") > 0), 1.0 / F.greatest("mean_qty", F.lit(1.0))).otherwise(F.lit(0.0))
    return grouped.withColumn("turnover_rate", rate).select(
        *POSITION, "snapshots",
        F.when(enough, F.col("mean_qty")).alias("avg_inventory"),
        "turnover_rate",
        F.when(F.col("turnover_rate") > 0, 1.0 / F.col("turnover_rate")).otherwise(F.lit(0.0))
        .alias("days_in_inventory"),
    )


def sufficiency(df: DataFrame, demand: DataFrame) -> DataFrame:
    """Projected stock per latest position: on hand + in transit - safety stock - demand; short when below zero.

    Positions without a demand row have no demand.
    """
    projected = (
        F.col("quantity_on_hand") + F.col("in_transit_qty") - F.col("safety_stock")
        - F.coalesce("demand_qty", F.lit(0.0))
    )
    return (
        latest(df)
        .join(demand, POSITION, "left")
        .select(*POSITION, "snapshot_date", *QUANTITIES,
                F.coalesce("demand_qty", F.lit(0.0)).alias("demand_qty"), projected.alias("projected_qty"))
        .withColumn("shortfall", F.col("projected_qty") < 0)
    )


def cost_overlay(df: DataFrame, costs: DataFrame) -> DataFrame:
    """Value each snapshot at the item cost valid on its date, start inclusive and end exclusive.

    An equi join on the item with a residual range test; an item has few cost
    versions, so the pairs tested stay proportional to the snapshots.
    """
    valid = costs.select(F.col("item_id").alias("cost_item_id"), "effective_start_ts", "effective_end_ts",
                         "cost_currency", "unit_cost")
    snapshot = ts(F.col("snapshot_date"))
    condition = (
        (F.col("item_id") == F.col("cost_item_id"))
        & (snapshot >= F.col("effective_start_ts"))
        & (F.col("effective_end_ts").isNull() | (snapshot < F.col("effective_end_ts")))
    )
    return df.join(valid, condition, "left").select(
        *SNAPSHOT, "quantity_on_hand", "cost_currency", "unit_cost",
        (F.col("quantity_on_hand") * F.col("unit_cost")).alias("stock_value"),
    )
