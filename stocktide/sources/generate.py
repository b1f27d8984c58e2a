"""Deterministic sample feeds and seed tables, computed by Spark from a row index."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stocktide.functions.timeexpr import ts
from stocktide.operators import crosswalk as xw
from stocktide.operators import freshness

# The rotating labels of the sample feeds.
REGIONS = ["North America", "Europe", "Asia Pacific", "Latin America"]
SUPPLIER_STATUS = ["active", "inactive", "pending"]
SHIPMENT_STATUS = ["planned", "in_transit", "delivered", "cancelled"]
ORIGINS = ["New York", "Los Angeles", "Chicago", "Houston", "Phoenix"]
DESTINATIONS = ["Miami", "Seattle", "Denver", "Boston", "Atlanta"]
LOCATIONS = ["WH001", "WH002", "WH003", "WH004", "WH005"]


def _pick(values: list[str], i: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (i % len(values) + 1).cast("int"))


def _numbered(prefix: str, n: Column, width: int) -> Column:
    return F.concat(F.lit(prefix), F.lpad(n.cast("string"), width, "0"))


def _stamp(base: str, days: Column, hours: int = 0) -> Column:
    moved = ts(base) + F.make_dt_interval(days=days.cast("int"), hours=F.lit(hours))
    return F.date_format(moved, "yyyy-MM-dd HH:mm:ss")


def suppliers(spark: SparkSession, n: int, as_of: str) -> DataFrame:
    i = F.col("id")
    k = i + 1
    text = k.cast("string")
    return spark.range(n).select(
        _numbered("SUP_", k, 6).alias("supplier_id"),
        F.concat(F.lit("Supplier "), text).alias("supplier_name"),
        _pick(SUPPLIER_STATUS, i).alias("status"),
        _pick(REGIONS, i).alias("region"),
        F.concat(F.lit("contact"), text, F.lit("@supplier"), text, F.lit(".com")).alias("contact_email"),
        _numbered("+1-555-", k, 4).alias("contact_phone"),
        F.concat(text, F.lit(" Main St, City "), text).alias("address"),
        F.concat(F.lit('{"category": "electronics", "tier": '), (i % 3 + 1).cast("string"), F.lit("}"))
        .alias("attributes"),
        F.date_format(ts(as_of), "yyyy-MM-dd HH:mm:ss").alias("last_updated"),
    )


def shipments(spark: SparkSession, n: int, as_of: str) -> DataFrame:
    i = F.col("id")
    k = i + 1
    return spark.range(n).select(
        _numbered("SHIP_", k, 6).alias("shipment_id"),
        _numbered("ROUTE_", k, 4).alias("route_id"),
        _numbered("CARR_", i % 10 + 1, 3).alias("carrier_id"),
        _pick(ORIGINS, i).alias("origin"),
        _pick(DESTINATIONS, i).alias("destination"),
        _stamp(as_of, i).alias("planned_departure"),
        _stamp(as_of, i, 1).alias("actual_departure"),
        _stamp(as_of, i + 2).alias("planned_arrival"),
        _stamp(as_of, i + 2, 2).alias("actual_arrival"),
        _pick(SHIPMENT_STATUS, i).alias("status"),
        _numbered("TRK", k, 8).alias("tracking_number"),
        (F.lit(100.0) + i * 10).alias("weight"),
        (F.lit(50.0) + i * 5).alias("volume"),
    )


def inventory(spark: SparkSession, n: int, as_of: str) -> DataFrame:
    i = F.col("id")
    return spark.range(n).select(
        _numbered("ITEM_", i + 1, 6).alias("item_id"),
        _pick(LOCATIONS, i).alias("location_id"),
        F.date_format(ts(as_of) - F.make_dt_interval(days=(i % 30).cast("int")), "yyyy-MM-dd").alias("snapshot_date"),
        (F.lit(100.0) + i * 10).alias("quantity_on_hand"),
        (F.lit(20.0) + i * 2).alias("safety_stock"),
        (F.lit(10.0) + i).alias("in_transit_qty"),
        (F.lit(5.0) + i * 0.5).alias("reserved_qty"),
        (F.lit(95.0) + i * 9.5).alias("available_qty"),
        (F.lit(10.0) + i * 0.1).alias("unit_cost"),
        F.date_format(ts(as_of) - F.make_dt_interval(days=(i % 7).cast("int")), "yyyy-MM-dd").alias("last_count_date"),
    )


GENERATORS = {"supplier": suppliers, "shipment": shipments, "inventory": inventory}

# Default crosswalk (source system, source key, business key) of the supplier domain.
DEFAULT_MAPPINGS = [
    ("erp_system", "SUP001", "SUP_ACME_CORP"),
    ("erp_system", "SUP002", "SUP_BETA_INC"),
    ("wms_system", "VENDOR_123", "SUP_ACME_CORP"),
    ("wms_system", "VENDOR_456", "SUP_BETA_INC"),
]


def default_crosswalk(spark: SparkSession, as_of: str, domain: str = "supplier") -> DataFrame:
    rows = [(s, k, domain, b) for s, k, b in DEFAULT_MAPPINGS] if domain == "supplier" else []
    seed = spark.createDataFrame(rows, "source_system string, source_key string, entity_type string, business_key string")
    nothing = spark.createDataFrame(
        [], "source_system string, source_key string, entity_type string, business_key string, confidence double, "
            "created_ts timestamp_ntz, is_active boolean, updated_ts timestamp_ntz")
    return xw.add_mappings(nothing, seed, as_of)


def initial_freshness(spark: SparkSession, as_of: str) -> DataFrame:
    """One ok row per domain, as if everything had just been loaded."""
    latest = spark.createDataFrame([(d,) for d in freshness.SLAS], "domain string").withColumn("last_updated", ts(as_of))
    return freshness.status(latest, as_of)
