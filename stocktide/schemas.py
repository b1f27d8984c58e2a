"""Schemas of every table, one StructType per canonical name."""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {
    "s": T.StringType(),
    "d": T.DoubleType(),
    "i": T.IntegerType(),
    "l": T.LongType(),
    "b": T.BooleanType(),
    "date": T.DateType(),
    "ts": T.TimestampNTZType(),
}


def _schema(spec: str, required: str = "") -> T.StructType:
    """``"name:type name:type"`` (type ``s`` when left out) to a StructType."""
    needed = set(required.split())
    fields = []
    for item in spec.split():
        name, _, code = item.partition(":")
        fields.append(T.StructField(name, _TYPES[code or "s"], name not in needed))
    return T.StructType(fields)


_META = " _ingestion_ts:ts _source_file _source_system"

SUPPLIER_RAW = _schema(
    "supplier_id supplier_name status region contact_email contact_phone address attributes last_updated",
    required="supplier_id supplier_name status",
)
SHIPMENT_RAW = _schema(
    "shipment_id route_id carrier_id origin destination planned_departure actual_departure planned_arrival "
    "actual_arrival status tracking_number weight:d volume:d",
    required="shipment_id route_id carrier_id origin destination status",
)
INVENTORY_RAW = _schema(
    "item_id location_id snapshot_date quantity_on_hand:d safety_stock:d in_transit_qty:d reserved_qty:d "
    "available_qty:d unit_cost:d last_count_date",
    required="item_id location_id snapshot_date quantity_on_hand safety_stock in_transit_qty",
)


def _landed(raw: T.StructType) -> T.StructType:
    return T.StructType(raw.fields + _schema(_META).fields)


TABLES: dict[str, T.StructType] = {
    "bronze.supplier_raw": _landed(SUPPLIER_RAW),
    "bronze.shipment_raw": _landed(SHIPMENT_RAW),
    "bronze.inventory_raw": _landed(INVENTORY_RAW),
    "bronze.raw_envelope": _schema("key source_system raw_data load_ts:ts file_name"),
    "silver.supplier_scd2": _schema(
        "natural_key business_key name status region attributes_json effective_start_ts:ts effective_end_ts:ts "
        "is_current:b source_system load_ts:ts created_at:ts",
        required="natural_key business_key name status effective_start_ts is_current source_system load_ts",
    ),
    "silver.shipment": _schema(
        "shipment_id route_id carrier_id origin destination planned_departure_ts:ts actual_departure_ts:ts "
        "planned_arrival_ts:ts actual_arrival_ts:ts status load_ts:ts source_system created_at:ts",
        required="shipment_id route_id carrier_id origin destination status load_ts source_system",
    ),
    "silver.inventory_position": _schema(
        "item_id location_id snapshot_date:date quantity_on_hand:d safety_stock:d in_transit_qty:d load_ts:ts "
        "source_system created_at:ts",
        required="item_id location_id snapshot_date quantity_on_hand safety_stock in_transit_qty load_ts source_system",
    ),
    "silver.crosswalk": _schema(
        "source_system source_key entity_type business_key confidence:d created_ts:ts is_active:b updated_ts:ts",
        required="source_system source_key entity_type business_key confidence created_ts is_active",
    ),
    "silver.supply_link": _schema("item_id location_id supplier_id", required="item_id location_id supplier_id"),
    "silver.cost_reference": _schema(
        "item_id effective_start_ts:ts effective_end_ts:ts cost_currency unit_cost:d is_current:b load_ts:ts "
        "source_system",
        required="item_id effective_start_ts",
    ),
    "gold.unified_supply_chain": _schema(
        "product_id location_id supplier_id supplier_name supplier_status supplier_region supplier_attributes "
        "quantity_on_hand:d safety_stock:d in_transit_qty:d inventory_date:date shipment_id route_id carrier_id "
        "origin destination planned_departure_ts:ts actual_departure_ts:ts planned_arrival_ts:ts "
        "actual_arrival_ts:ts shipment_status inventory_source supplier_source shipment_source "
        "inventory_load_ts:ts shipment_load_ts:ts stock_status delivery_delay_days:i is_delivered:b "
        "view_created_ts:ts last_data_update_ts:ts item_id",
        required="product_id location_id",
    ),
    "gold.supplier_performance": _schema(
        "supplier_id supplier_name supplier_region total_shipments:l delivered_shipments:l delivered_rate:d "
        "on_time_deliveries:l on_time_rate:d avg_delay_days:d total_products:l avg_inventory_turnover:d "
        "performance_score:d last_updated:ts",
        required="supplier_id",
    ),
    "gold.inventory_metrics": _schema(
        "product_id location_id supplier_id total_inventory:d safety_stock_level:d stockout_risk turnover_rate:d "
        "days_in_inventory:d last_movement_date:date last_updated:ts",
        required="product_id location_id",
    ),
    "gold.shipment_performance": _schema(
        "carrier_id route_id total_shipments:l delivered_shipments:l delayed_shipments:l cancelled_shipments:l "
        "delivered_rate:d on_time_shipments:l on_time_rate:d avg_delay_days:d avg_delay_hours:d "
        "avg_transit_days:d last_updated:ts",
        required="carrier_id",
    ),
    "ops.freshness_status": _schema(
        "domain last_updated:ts target_sla_minutes:i warning_threshold_minutes:i breach_threshold_minutes:i status "
        "age_minutes:i created_ts:ts updated_ts:ts",
        required="domain last_updated",
    ),
    "ops.publish_gate_log": _schema(
        "evaluation_id dataset table_name status can_publish:b total_checks:i passed_checks:i failed_checks:i "
        "critical_failures:i warning_failures:i info_failures:i evaluation_time:ts message created_ts:ts",
        required="evaluation_id dataset table_name status can_publish",
    ),
    "ops.schema_validation_log": _schema(
        "validation_id schema_name source_system is_valid:b total_records:l valid_records:l invalid_records:l "
        "error_count:l warning_count:l validation_time:ts errors_json created_ts:ts",
        required="validation_id schema_name source_system is_valid",
    ),
    "ops.dq_status": _schema("dataset check_id check_result:b severity message check_ts:ts"),
    "ops.data_quality_status": _schema(
        "table_name check_timestamp:ts critical_checks_passed:b failed_checks_count:i quality_score:d details "
        "created_ts:ts"
    ),
    "ops.lineage": _schema("run_id target source_table rows_written:l recorded_ts:ts"),
    "ops.alerts": _schema("alert_type subject severity message detected_ts:ts due_ts:ts"),
    "ops.pipeline_metrics": _schema("run_id stage domain rows_out:l seconds:d rows_per_second:d"),
}

# Partition columns used by the writers.
PARTITIONS: dict[str, list[str]] = {
    "bronze.supplier_raw": ["_source_system"],
    "bronze.shipment_raw": ["_source_system"],
    "bronze.inventory_raw": ["_source_system"],
    "silver.supplier_scd2": ["source_system"],
    "silver.shipment": ["source_system", "status"],
    "silver.inventory_position": ["source_system", "snapshot_date"],
    "gold.unified_supply_chain": ["supplier_region", "inventory_date"],
    "gold.supplier_performance": ["supplier_region"],
    "gold.inventory_metrics": ["location_id"],
    "gold.shipment_performance": ["carrier_id"],
}

# What a reader should know about a column; used by the data dictionary.
DESCRIPTIONS: dict[str, str] = {
    "product_id": "Business key of the product, from the crosswalk where one is known",
    "supplier_id": "Business key of the supplier, from the crosswalk where one is known",
    "stock_status": "healthy, at_risk or stockout from quantity against safety stock",
    "delivery_delay_days": "Calendar days late (positive) or early (negative)",
    "last_data_update_ts": "Latest load time over the joined source rows",
    "is_current": "True for the open version of the key",
    "effective_start_ts": "First instant the version holds",
    "effective_end_ts": "First instant the version no longer holds; null while current",
}
