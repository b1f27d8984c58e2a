"""Supplier history: type-2 slowly changing dimension."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stocktide.functions.timeexpr import ts
from stocktide.operators.asof import as_of_join
from stocktide.operators.common import first_per_key, require_columns, with_missing

TRACKED = ["name", "status", "region", "attributes_json"]
REQUIRED = ["natural_key", "business_key", "name", "status", "source_system", "load_ts"]


def conform(raw: DataFrame) -> DataFrame:
    """Bronze supplier layout to the change-feed layout; the business key is the natural key until resolved."""
    return raw.select(
        F.col("supplier_id").alias("natural_key"),
        F.col("supplier_id").alias("business_key"),
        F.col("supplier_name").alias("name"),
        "status", "region",
        F.coalesce("attributes", F.lit("{}")).alias("attributes_json"),
        F.col("_source_system").alias("source_system"),
        F.col("_ingestion_ts").alias("load_ts"),
    )


def _prepared(feed: DataFrame) -> DataFrame:
    require_columns(feed, REQUIRED, "supplier")
    feed = with_missing(
        feed, attributes_json=F.lit("{}"), region=F.lit(None).cast("string"),
        effective_start_ts=F.lit(None).cast("timestamp_ntz"),
    )
    return feed.withColumn("effective_start_ts", F.coalesce("effective_start_ts", "load_ts")).select(
        *REQUIRED[:2], *TRACKED, "source_system", "load_ts", "effective_start_ts"
    )


def _state() -> Column:
    return F.struct(*TRACKED)


def build(feed: DataFrame, slice_unit: str = "day") -> DataFrame:
    """Full history from a change feed: one row per run of equal attributes, [start, end).

    Change detection works inside (key, time slice) groups. Only the first and
    last row kept of a slice also take part in the per-key step, which links the
    slices; the rows between are already complete. A supplier with a very large
    share of the feed is thereby spread over its slices instead of one task.
    """
    rows = (
        _prepared(feed)
        .withColumn("_slice", F.date_trunc(slice_unit, "effective_start_ts"))
        .repartition("business_key", "_slice")
    )
    rows = first_per_key(rows, ["business_key", "_slice", "effective_start_ts"], [F.col("load_ts").desc_nulls_last()])
    start = F.col("effective_start_ts")
    inside = Window.partitionBy("business_key", "_slice").orderBy(start)

    # 1. drop repeats inside a slice
    kept = (
        rows.withColumn("_before", F.lag(_state()).over(inside))
        .filter(F.col("_before").isNull() | ~F.col("_before").eqNullSafe(_state()))
        .withColumns({"_first": F.col("_before").isNull(), "_next": F.lead(start).over(inside)})
    )

    # 2. link the slices through their outermost rows: the first row of a slice is dropped when it
    #    repeats the state the slice before ended with
    between = ~F.col("_first") & F.col("_next").isNotNull()
    linked = kept.withColumn("_link", F.when(between, F.col("_slice")))
    forward = Window.partitionBy("business_key", "_link").orderBy(start)
    carried = F.lag(_state()).over(forward)
    backward = Window.partitionBy("business_key", "_link").orderBy(start.desc()).rowsBetween(
        Window.unboundedPreceding, -1)
    opens = F.when(F.col("_first"), F.when(F.col("_opens_version"), start).otherwise(F.col("_next")))
    return (
        linked.withColumn("_carried", carried)
        .withColumn("_opens_version", ~F.col("_first") | F.col("_carried").isNull()
                    | ~F.col("_carried").eqNullSafe(_state()))
        .withColumn("_next_slice", F.last(opens, ignorenulls=True).over(backward))
        .filter("_opens_version")
        .withColumn("effective_end_ts", F.coalesce("_next", "_next_slice"))
        .withColumn("is_current", F.col("effective_end_ts").isNull())
        .select("natural_key", "business_key", *TRACKED, "effective_start_ts", "effective_end_ts", "is_current",
                "source_system", "load_ts")
    )


def _changes(dim: DataFrame, incoming: DataFrame) -> DataFrame:
    """The batch's latest row per key where it differs from the current version, with ``_in_order``."""
    batch = first_per_key(_prepared(incoming), ["business_key"],
                          [F.col("effective_start_ts").desc_nulls_last(), F.col("load_ts").desc_nulls_last()])
    held = dim.filter("is_current").select("business_key", F.struct(*TRACKED).alias("_held"),
                                           F.col("effective_start_ts").alias("_held_since"))
    compared = batch.join(held, "business_key", "left")
    is_new = F.col("_held_since").isNull()
    differs = ~F.col("_held").eqNullSafe(_state())
    follows = F.col("effective_start_ts") > F.col("_held_since")
    earlier = F.col("effective_start_ts") < F.col("_held_since")
    return (
        compared.withColumn("_in_order", is_new | follows)
        .filter(is_new | differs | earlier)
        .drop("_held", "_held_since")
    )


def merge(dim: DataFrame, incoming: DataFrame, corrections: bool = True) -> DataFrame:
    """Apply a batch: close changed current rows and open new ones, sharing the boundary instant.

    The batch is reduced to its latest row per key. Unchanged keys and keys
    absent from the batch stay as they are, so a rerun changes nothing. A row
    older than the current version corrects the past: the history of its key is
    rebuilt. For feeds that only move forward, ``corrections=False`` leaves
    history untouched, joins current rows only, and raises nothing for older rows:
    they must not occur.
    """
    changes = _changes(dim, incoming)
    if corrections:
        return correct(dim, changes.drop("_in_order"))
    opened = changes.filter("_in_order").drop("_in_order")
    boundary = opened.select("business_key", F.col("effective_start_ts").alias("_closed_at"))
    open_rows = (
        dim.filter("is_current")
        .join(boundary, "business_key", "left")
        .withColumns({
            "effective_end_ts": F.col("_closed_at"),
            "is_current": F.col("_closed_at").isNull(),
        })
        .drop("_closed_at")
    )
    added = opened.withColumns({
        "effective_end_ts": F.lit(None).cast("timestamp_ntz"),
        "is_current": F.lit(True),
    })
    return (
        dim.filter("NOT is_current").unionByName(open_rows).unionByName(added, allowMissingColumns=True)
        .select(*dim.columns)
    )


def correct(dim: DataFrame, late_rows: DataFrame) -> DataFrame:
    """Insert rows that lie in the past: the history of every touched key is rebuilt, other keys pass through."""
    touched = late_rows.select("business_key").distinct()
    replay = (
        dim.join(touched, "business_key", "left_semi")
        .unionByName(late_rows, allowMissingColumns=True)
        .select(*REQUIRED[:2], *TRACKED, "source_system", "load_ts", "effective_start_ts")
    )
    untouched = dim.join(touched, "business_key", "left_anti")
    return untouched.unionByName(build(replay), allowMissingColumns=True).select(*dim.columns)


def current(dim: DataFrame) -> DataFrame:
    return dim.filter("is_current")


def history(dim: DataFrame, business_key: str) -> DataFrame:
    return dim.filter(F.col("business_key") == business_key).orderBy("effective_start_ts")


def by_natural_key(dim: DataFrame, natural_key: str, source_system: str) -> DataFrame:
    """The current row of one source key (at most one row)."""
    return dim.filter(
        F.col("is_current") & (F.col("natural_key") == natural_key) & (F.col("source_system") == source_system)
    ).limit(1)


def lookup_natural_keys(dim: DataFrame, keys: DataFrame) -> DataFrame:
    """Current rows for a table of (natural_key, source_system)."""
    return current(dim).join(keys.select("natural_key", "source_system").distinct(),
                             ["natural_key", "source_system"], "left_semi")


def current_projection(dim: DataFrame) -> DataFrame:
    """Current suppliers under the names the unified table uses."""
    return current(dim).select(
        F.col("business_key").alias("supplier_id"),
        F.col("name").alias("supplier_name"),
        F.col("status").alias("supplier_status"),
        F.col("region").alias("supplier_region"),
        F.col("attributes_json").alias("supplier_attributes"),
        F.col("effective_start_ts").alias("supplier_effective_start"),
        F.col("source_system").alias("supplier_source"),
    )


def as_of(dim: DataFrame, when: str | Column) -> DataFrame:
    """The version of every supplier at an instant."""
    at = ts(when)
    return dim.filter(
        (F.col("effective_start_ts") <= at) & (F.col("effective_end_ts").isNull() | (at < F.col("effective_end_ts")))
    )


def at_event_time(events: DataFrame, dim: DataFrame, key: str, time: str, slice_unit: str = "month") -> DataFrame:
    """Attach to each event the supplier version valid at its time; no event meets all versions of its supplier."""
    versions = dim.select(
        "business_key", F.col("effective_start_ts").alias("version_start_ts"), F.col("effective_end_ts").alias("_end"),
        F.col("status").alias("supplier_status"), F.col("region").alias("supplier_region"),
    )
    return as_of_join(events, versions, key, time, "business_key", "version_start_ts",
                      ["version_start_ts", "supplier_status", "supplier_region"], "_end", slice_unit)
