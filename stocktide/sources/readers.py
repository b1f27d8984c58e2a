"""File sources: CSV, JSON lines, parquet and text envelopes, always with a declared schema."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stocktide import schemas
from stocktide.functions.timeexpr import parse_date, parse_ts, ts
from stocktide.operators.shipments import TIME_COLUMNS

CORRUPT = "_corrupt_record"


@dataclass(frozen=True)
class Domain:
    """One ingest domain: raw schema, default source system, bronze table, required columns."""

    name: str
    schema: T.StructType
    source_system: str
    table: str
    required: tuple[str, ...]


DOMAINS: dict[str, Domain] = {
    "supplier": Domain("supplier", schemas.SUPPLIER_RAW, "supplier_system", "bronze.supplier_raw",
                       ("supplier_id", "supplier_name", "status", "region")),
    "shipment": Domain("shipment", schemas.SHIPMENT_RAW, "logistics_system", "bronze.shipment_raw",
                       ("shipment_id", "route_id", "carrier_id", "origin", "destination", "status")),
    "inventory": Domain("inventory", schemas.INVENTORY_RAW, "inventory_system", "bronze.inventory_raw",
                        ("item_id", "location_id", "snapshot_date", "quantity_on_hand")),
}


def text_schema(schema: T.StructType) -> T.StructType:
    """The same columns, all strings and nullable, as CSV and dirty JSON deliver them."""
    return T.StructType([T.StructField(f.name, T.StringType(), True) for f in schema.fields])


def _format_of(path: str) -> str:
    for suffix, name in ((".csv", "csv"), (".json", "json"), (".jsonl", "json"), (".parquet", "parquet")):
        if path.rstrip("/").endswith(suffix):
            return name
    raise ValueError(f"Unsupported file format: {path}")


def _fitted(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns of the schema in order (NULL where absent), then the columns it does not know."""
    known = [F.col(f.name) if f.name in df.columns else F.lit(None).cast("string").alias(f.name) for f in schema.fields]
    extra = [c for c in df.columns if c not in schema.fieldNames()]
    return df.select(*known, *extra)


def read_raw(spark: SparkSession, path: str, schema: T.StructType, fmt: str | None = None) -> DataFrame:
    """Raw text columns of the schema from CSV (header row) or JSON lines; parquet as stored.

    CSV columns are taken by header name, and every file must carry the same
    header. Malformed JSON lines survive with all columns NULL and the line in
    ``_corrupt_record``. No types are inferred.
    """
    fmt = fmt or _format_of(path)
    if fmt == "csv":
        header = spark.read.option("header", True).csv(path).columns
        text = T.StructType([T.StructField(c, T.StringType(), True) for c in header])
        return _fitted(
            spark.read.schema(text).option("header", True).option("enforceSchema", False).csv(path), schema)
    if fmt == "json":
        text = T.StructType(text_schema(schema).fields + [T.StructField(CORRUPT, T.StringType(), True)])
        return (spark.read.schema(text).option("mode", "PERMISSIVE")
                .option("columnNameOfCorruptRecord", CORRUPT).json(path))
    if fmt == "parquet":
        return _fitted(spark.read.parquet(path), schema)
    raise ValueError(f"Unsupported file format: {fmt}")


def _clean_label(c: Column) -> Column:
    return F.trim(F.upper(c))


def typed(raw: DataFrame, domain: str) -> DataFrame:
    """Text columns to the types of the domain; values that do not parse become NULL.

    Supplier names and regions are trimmed and upper-cased, statuses lower-cased,
    and a missing JSON attribute becomes ``{}``.
    """
    schema = DOMAINS[domain].schema
    changes: dict[str, Column] = {
        f.name: F.col(f.name).try_cast("double")
        for f in schema.fields if isinstance(f.dataType, T.DoubleType)
    }
    if domain == "supplier":
        changes.update({
            "supplier_name": _clean_label(F.col("supplier_name")),
            "region": _clean_label(F.col("region")),
            "status": F.trim(F.lower("status")),
            "attributes": F.coalesce("attributes", F.lit("{}")),
            "last_updated": parse_ts(F.col("last_updated")),
        })
    elif domain == "shipment":
        changes.update({c: parse_ts(F.col(c)) for c in TIME_COLUMNS})
    elif domain == "inventory":
        changes.update({c: parse_date(F.col(c)) for c in ("snapshot_date", "last_count_date")})
    return raw.withColumns(changes)


def with_metadata(df: DataFrame, source_system: str, ingested_at: str | None = None) -> DataFrame:
    """Ingestion time, the file each row came from, and the source system."""
    when = ts(ingested_at) if ingested_at else F.current_timestamp().cast("timestamp_ntz")
    return df.withColumns({
        "_ingestion_ts": when,
        "_source_file": F.col("_metadata.file_path"),
        "_source_system": F.lit(source_system),
    })


def load(spark: SparkSession, domain: str, path: str, ingested_at: str | None = None, fmt: str | None = None,
         source_system: str | None = None) -> DataFrame:
    """Raw text rows of a domain with metadata columns, before typing."""
    if domain not in DOMAINS:
        raise ValueError(f"Unknown domain: {domain}")
    spec = DOMAINS[domain]
    return with_metadata(read_raw(spark, path, spec.schema, fmt), source_system or spec.source_system, ingested_at)


def read_envelope(spark: SparkSession, path: str, key_field: str, source_system: str, loaded_at: str) -> DataFrame:
    """Payload landing: every line as one string next to its key, source, load time and file."""
    return spark.read.text(path).select(
        F.get_json_object("value", f"$.{key_field}").alias("key"),
        F.lit(source_system).alias("source_system"),
        F.col("value").alias("raw_data"),
        ts(loaded_at).alias("load_ts"),
        F.col("_metadata.file_path").alias("file_name"),
    )


def open_envelope(envelope: DataFrame, schema: T.StructType) -> DataFrame:
    """Payload columns back out of an envelope."""
    return envelope.select("key", "source_system", "load_ts",
                           F.from_json("raw_data", text_schema(schema)).alias("p")).select(
        "key", "source_system", "load_ts", "p.*")
