"""Shipment conformance, lookups and delivery metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stocktide.functions import labels
from stocktide.functions.timeexpr import hours_between, plus_days, plus_hours, ts
from stocktide.operators.common import first_per_key, merge_latest, require_columns, with_missing

REQUIRED = ["shipment_id", "route_id", "carrier_id", "origin", "destination", "status", "source_system"]
TIME_COLUMNS = ["planned_departure", "actual_departure", "planned_arrival", "actual_arrival"]


def conform(raw: DataFrame) -> DataFrame:
    """Bronze layout to silver layout: the four time columns get their ``_ts`` names."""
    return raw.select(
        "shipment_id", "route_id", "carrier_id", "origin", "destination",
        *[F.col(c).alias(f"{c}_ts") for c in TIME_COLUMNS],
        "status",
        F.col("_source_system").alias("source_system"),
        F.col("_ingestion_ts").alias("load_ts"),
    )


def known_status(status: Column) -> Column:
    """Statuses outside the domain, and nulls, become ``planned``."""
    return F.when(status.isin(labels.SHIPMENT_STATUSES), status).otherwise(F.lit("planned"))


def departure_not_after(departure: Column, arrival: Column) -> Column:
    """A departure later than its arrival is set to the arrival; nulls are left alone."""
    return F.when(departure > arrival, arrival).otherwise(departure)


def clean(df: DataFrame, as_of: str | None = None) -> DataFrame:
    """Status whitelist, then planned-time repair, then actual-time repair."""
    require_columns(df, REQUIRED, "shipment")
    df = with_missing(df, load_ts=ts(as_of) if as_of else F.current_timestamp().cast("timestamp_ntz"))
    return df.withColumns({
        "status": known_status(F.col("status")),
        "planned_departure_ts": departure_not_after(F.col("planned_departure_ts"), F.col("planned_arrival_ts")),
        "actual_departure_ts": departure_not_after(F.col("actual_departure_ts"), F.col("actual_arrival_ts")),
    })


def latest_version(df: DataFrame) -> DataFrame:
    """The latest loaded row per shipment_id."""
    return first_per_key(df, ["shipment_id"], [F.col("load_ts").desc_nulls_last()])


def newest(incoming: DataFrame, as_of: str | None = None) -> DataFrame:
    """The rows that a batch puts in force: cleaned, the latest row per shipment_id."""
    return latest_version(clean(incoming, as_of))


def upsert(existing: DataFrame, incoming: DataFrame, as_of: str | None = None) -> DataFrame:
    """Clean the incoming rows and keep the latest row per shipment_id; a rerun changes nothing."""
    return merge_latest(existing, clean(incoming, as_of), ["shipment_id"], [F.col("load_ts").desc_nulls_last()])


def by_route(df: DataFrame, route_id: str) -> DataFrame:
    return df.filter(F.col("route_id") == route_id).orderBy("planned_departure_ts")


def by_carrier(df: DataFrame, carrier_id: str, status: str | None = None) -> DataFrame:
    found = df.filter(F.col("carrier_id") == carrier_id)
    if status:
        found = found.filter(F.col("status") == status)
    return found.orderBy("planned_departure_ts")


def active(df: DataFrame) -> DataFrame:
    return df.filter(F.col("status") == "in_transit").orderBy("planned_departure_ts")


def delayed(df: DataFrame, threshold_hours: int = 24) -> DataFrame:
    """In transit and departed more than the threshold after plan."""
    return df.filter(
        (F.col("status") == "in_transit")
        & (F.col("actual_departure_ts") > plus_hours(F.col("planned_departure_ts"), threshold_hours))
    )


def recent_active(df: DataFrame, as_of: str, days: int | None = 30) -> DataFrame:
    """In transit or delivered, planned to depart within ``days`` before the date of ``as_of`` (None: no limit)."""
    found = df.filter(F.col("status").isin("in_transit", "delivered"))
    if days is None:
        return found
    return found.filter(F.col("planned_departure_ts") >= plus_days(F.date_trunc("day", ts(as_of)).cast("timestamp_ntz"), -days))


def delivery_metrics(df: DataFrame) -> DataFrame:
    """Per carrier over delivered rows with both arrivals: count, share on time, mean delay in hours."""
    delay = hours_between(F.col("planned_arrival_ts"), F.col("actual_arrival_ts"))
    return (
        df.filter(
            (F.col("status") == "delivered")
            & F.col("actual_arrival_ts").isNotNull()
            & F.col("planned_arrival_ts").isNotNull()
        )
        .select("carrier_id", "shipment_id", delay.alias("delay_hours"))
        .groupBy("carrier_id")
        .agg(
            F.count("shipment_id").alias("total_shipments"),
            labels.share_where(F.col("delay_hours") <= 0).alias("on_time_rate"),
            F.avg("delay_hours").alias("avg_delay_hours"),
        )
    )


def lead_time(shipments: DataFrame) -> DataFrame:
    """Mean days from actual departure to actual arrival of delivered shipments, per supplier and route."""
    hours = hours_between(F.col("actual_departure_ts"), F.col("actual_arrival_ts"))
    return (
        shipments.filter(
            (F.col("status") == "delivered")
            & F.col("actual_departure_ts").isNotNull()
            & F.col("actual_arrival_ts").isNotNull()
        )
        .groupBy(F.col("carrier_id").alias("supplier_id"), "route_id")
        .agg(F.count("*").alias("delivered_shipments"), (F.avg(hours) / 24).alias("avg_lead_time_days"))
    )


def capacity_utilisation(volumes: DataFrame, capacity: DataFrame) -> DataFrame:
    """Shipped volume per carrier and week (starting Monday) against the carrier's weekly capacity.

    Volumes are summed before the join, so the join sees one row per carrier and week.
    """
    weekly = volumes.groupBy(
        "carrier_id", F.date_trunc("week", "planned_departure_ts").cast("date").alias("week_start")
    ).agg(F.sum("volume").alias("shipped_volume"))
    return weekly.join(capacity, "carrier_id", "left").select(
        "carrier_id", "week_start", "shipped_volume", "weekly_capacity",
        F.try_divide("shipped_volume", "weekly_capacity").alias("utilisation"),
    )
