"""Retention, masking, lineage, metrics, dictionary and layout of published tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stocktide import schemas
from stocktide.functions.timeexpr import plus_days, seconds_between, ts

# Retention in days per layer.
RETENTION_DAYS = {"bronze": 90, "silver": 365, "gold": 365, "ops": 90}


def within_retention(df: DataFrame, layer: str, as_of: str, time: str = "load_ts") -> DataFrame:
    """Rows to keep: a range filter on the time; a row without a time isn't expired and stays."""
    return df.filter(F.col(time).isNull() | (F.col(time) >= plus_days(ts(as_of), -RETENTION_DAYS[layer])))


def expired(df: DataFrame, layer: str, as_of: str, time: str = "load_ts") -> DataFrame:
    return df.filter(F.col(time) < plus_days(ts(as_of), -RETENTION_DAYS[layer]))


# What each role sees of a sensitive column: clear, hash, mask or drop. Least privilege by default.
ROLES = ("engineer", "analyst", "auditor", "external_partner")
SENSITIVE: dict[str, dict[str, str]] = {
    "contact_email": {"engineer": "clear", "analyst": "hash"},
    "contact_phone": {"engineer": "clear", "analyst": "mask"},
    "address": {"engineer": "clear"},
    "attributes_json": {"engineer": "clear", "analyst": "clear"},
    "supplier_attributes": {"engineer": "clear", "analyst": "clear"},
    "unit_cost": {"engineer": "clear", "analyst": "clear"},
    "name": {"engineer": "clear", "analyst": "clear", "auditor": "hash", "external_partner": "hash"},
    "supplier_name": {"engineer": "clear", "analyst": "clear", "auditor": "hash", "external_partner": "hash"},
}


def _shown(name: str, how: str) -> Column | None:
    c = F.col(name)
    if how == "clear":
        return c
    if how == "hash":
        return F.sha2(c.cast("string"), 256).alias(name)
    if how == "mask":
        return F.mask(c.cast("string")).alias(name)
    return None


def masked_for(df: DataFrame, role: str, region: str | None = None, region_column: str = "region",
               policy: Mapping[str, Mapping[str, str]] = SENSITIVE) -> DataFrame:
    """The columns a role may see; external partners must name the one region they see."""
    if role not in ROLES:
        raise ValueError(f"unknown role {role}")
    if role == "external_partner" and region is None:
        raise PermissionError("external partners read one region only")
    if region is not None:
        df = df.filter(F.col(region_column) == region)
    shown = [_shown(c, policy[c].get(role, "drop") if c in policy else "clear") for c in df.columns]
    return df.select(*[c for c in shown if c is not None])


def lineage(spark: SparkSession, run_id: str, target: str, inputs: Sequence[str], rows_written: int | None,
            as_of: str) -> DataFrame:
    """One lineage row per input of a written table."""
    rows = [(run_id, target, source, rows_written) for source in inputs]
    return spark.createDataFrame(
        rows, "run_id string, target string, source_table string, rows_written bigint"
    ).withColumn("recorded_ts", ts(as_of))


def lineage_from_counts(target: DataFrame, run_id: str, target_name: str, inputs: Sequence[str], as_of: str) -> DataFrame:
    """Lineage rows whose row count is taken from the written table by Spark."""
    return target.agg(F.count("*").alias("rows_written")).select(
        F.lit(run_id).alias("run_id"), F.lit(target_name).alias("target"),
        F.explode(F.array(*[F.lit(i) for i in inputs])).alias("source_table"), "rows_written",
        ts(as_of).alias("recorded_ts"),
    )


def load_metrics(df: DataFrame, key: str = "source_system", time: str = "load_ts") -> DataFrame:
    """Throughput per source system and load day: rows, first and last load, seconds spanned."""
    return (
        df.groupBy(key, F.to_date(time).alias("load_date"))
        .agg(F.count("*").alias("rows_loaded"), F.min(time).alias("first_load_ts"), F.max(time).alias("last_load_ts"))
        .withColumn("span_seconds", seconds_between(F.col("first_load_ts"), F.col("last_load_ts")))
    )


def data_dictionary(spark: SparkSession, tables: Mapping[str, T.StructType] = schemas.TABLES) -> DataFrame:
    """One row per column of every table."""
    rows = [
        (name, position, f.name, f.dataType.simpleString(), f.nullable,
         f.name in schemas.PARTITIONS.get(name, []), f.name in SENSITIVE, schemas.DESCRIPTIONS.get(f.name))
        for name, schema in tables.items()
        for position, f in enumerate(schema.fields)
    ]
    return spark.createDataFrame(
        rows, "table_name string, position int, column_name string, data_type string, nullable boolean, "
              "partition_column boolean, sensitive boolean, description string")


def column_profile(df: DataFrame, table: str) -> DataFrame:
    """Data dictionary of a frame with measured fill: rows, nulls and approximate distinct values per column."""
    stats = df.agg(
        F.count("*").alias("rows"),
        *[F.count_if(F.col(c).isNull()).alias(f"null__{c}") for c in df.columns],
    )
    pairs = F.array(*[
        F.struct(F.lit(i).alias("position"), F.lit(f.name).alias("column_name"),
                 F.lit(f.dataType.simpleString()).alias("data_type"), F.col("rows").alias("row_count"),
                 F.col(f"null__{f.name}").alias("null_count"))
        for i, f in enumerate(df.schema.fields)
    ])
    return stats.select(F.inline(pairs)).select(F.lit(table).alias("table_name"), "*")


def clustered(df: DataFrame, columns: Sequence[str], partitions: int | None = None) -> DataFrame:
    """Range-partition and sort for writing, so files hold narrow ranges of the columns and skip well.

    Without ``partitions`` adaptive execution sizes the output.
    """
    ranged = df.repartitionByRange(partitions, *columns) if partitions else df.repartitionByRange(*columns)
    return ranged.sortWithinPartitions(*columns)


def evolve(df: DataFrame, target: T.StructType) -> tuple[DataFrame, list[str]]:
    """Fit a frame to a table's schema: missing columns as NULL, new columns kept at the end and reported."""
    known = {f.name: f.dataType for f in target.fields}
    added = [c for c in df.columns if c not in known]
    fitted = df.select(
        *[F.col(n).cast(t).alias(n) if n in df.columns else F.lit(None).cast(t).alias(n) for n, t in known.items()],
        *added,
    )
    return fitted, added
