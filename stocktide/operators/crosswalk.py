"""Crosswalk: source keys of each system to business keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stocktide.functions.timeexpr import ts
from stocktide.operators.common import first_per_key

KEY = ["source_system", "source_key", "entity_type"]


def best_mappings(crosswalk: DataFrame, keys: Sequence[str] = KEY) -> DataFrame:
    """The best active mapping per key: highest confidence, then newest, then smallest business key."""
    live = crosswalk.filter("is_active").select(*KEY, "business_key", "confidence", "created_ts")
    return first_per_key(
        live, list(keys), [F.col("confidence").desc_nulls_last(), F.col("created_ts").desc_nulls_last(),
                           F.col("business_key").asc_nulls_last()]
    )


def resolve_keys(records: DataFrame, crosswalk: DataFrame) -> DataFrame:
    """Attach ``business_key`` (NULL when unmapped) to records carrying the three key columns.

    The mapping side has one row per key, so the join never fans out.
    """
    best = best_mappings(crosswalk).select(*KEY, "business_key")
    return records.drop("business_key").join(best, KEY, "left")


def mappings_for_entity(crosswalk: DataFrame, entity_type: str) -> DataFrame:
    return (
        crosswalk.filter(F.col("is_active") & (F.col("entity_type") == entity_type))
        .select("source_system", "source_key", "business_key", "confidence", "created_ts")
        .orderBy("source_system", "source_key")
    )


def add_mappings(crosswalk: DataFrame, mappings: DataFrame, as_of: str) -> DataFrame:
    """Append mappings; confidence defaults to 1.0 and the mapping starts active."""
    confidence = F.col("confidence") if "confidence" in mappings.columns else F.lit(None).cast("double")
    added = mappings.select(
        *KEY, "business_key",
        F.coalesce(confidence, F.lit(1.0)).alias("confidence"),
        ts(as_of).alias("created_ts"),
        F.lit(True).alias("is_active"),
        ts(as_of).alias("updated_ts"),
    )
    return crosswalk.unionByName(added, allowMissingColumns=True)


def deactivate(crosswalk: DataFrame, keys: DataFrame, as_of: str) -> DataFrame:
    """Mark the active mappings of the given keys inactive and stamp ``updated_ts``."""
    if "updated_ts" not in crosswalk.columns:
        crosswalk = crosswalk.withColumn("updated_ts", F.lit(None).cast("timestamp_ntz"))
    marks = keys.select(*KEY).distinct().withColumn("_off", F.lit(True))
    hit = F.col("_off").isNotNull() & F.col("is_active")
    return (
        crosswalk.join(marks, KEY, "left")
        .withColumns({
            "updated_ts": F.when(hit, ts(as_of)).otherwise(F.col("updated_ts")),
            "is_active": F.when(hit, F.lit(False)).otherwise(F.col("is_active")),
        })
        .drop("_off")
        .select(*crosswalk.columns)
    )


def duplicate_mappings(crosswalk: DataFrame) -> DataFrame:
    """Keys with more than one active mapping."""
    return (
        crosswalk.filter("is_active").groupBy(*KEY).agg(F.count("*").alias("mappings")).filter("mappings > 1")
    )


def integrity(crosswalk: DataFrame) -> DataFrame:
    """One row: active mappings and how many keys have more than one."""
    per_key = crosswalk.filter("is_active").groupBy(*KEY).agg(F.count("*").alias("mappings"))
    return per_key.agg(
        F.coalesce(F.sum("mappings"), F.lit(0)).alias("total_active_mappings"),
        F.count_if(F.col("mappings") > 1).alias("duplicate_mappings"),
    )
