"""Freshness of each domain against its service levels."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stocktide.functions import labels
from stocktide.functions.timeexpr import ts, whole_minutes_between
from stocktide.operators.common import first_per_key


@dataclass(frozen=True)
class Sla:
    target_minutes: int
    warning_minutes: int
    breach_minutes: int


# Service levels in minutes (target, warning, breach).
SLAS: dict[str, Sla] = {
    "supplier": Sla(1440, 1200, 1500),
    "logistics": Sla(60, 45, 75),
    "inventory": Sla(5, 3, 8),
}


def slas_for(domains: Iterable[str], slas: Mapping[str, Sla] = SLAS) -> dict[str, Sla]:
    wanted = set(domains)
    return {d: s for d, s in slas.items() if d in wanted}


def sla_table(spark: SparkSession, slas: Mapping[str, Sla] = SLAS) -> DataFrame:
    rows = [(d, s.target_minutes, s.warning_minutes, s.breach_minutes) for d, s in slas.items()]
    return spark.createDataFrame(
        rows,
        "domain string, target_sla_minutes int, warning_threshold_minutes int, breach_threshold_minutes int",
    )


def latest_loads(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(domain, last_updated): the latest load time of every domain; an empty table gives NULL."""
    parts = [
        df.agg(F.max("load_ts").cast("timestamp_ntz").alias("last_updated"))
        .select(F.lit(domain).alias("domain"), "last_updated")
        for domain, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def _of_domain(slas: Mapping[str, Sla], field: str) -> Column:
    """The domain's threshold as an expression; NULL for a domain without service level."""
    chosen = F.lit(None).cast("int")
    for domain, sla in slas.items():
        chosen = F.when(F.col("domain") == domain, F.lit(getattr(sla, field))).otherwise(chosen)
    return chosen


def status(latest: DataFrame, as_of: str, slas: Mapping[str, Sla] = SLAS) -> DataFrame:
    """Age and ok / warning / breach per domain with a service level; without data the status is ``missing``."""
    measured = latest.filter(F.col("domain").isin(list(slas))).select(
        "domain", "last_updated",
        _of_domain(slas, "target_minutes").alias("target_sla_minutes"),
        _of_domain(slas, "warning_minutes").alias("warning_threshold_minutes"),
        _of_domain(slas, "breach_minutes").alias("breach_threshold_minutes"),
        whole_minutes_between(F.col("last_updated"), ts(as_of)).alias("age_minutes"),
    )
    label = labels.freshness_label(F.col("age_minutes"), F.col("warning_threshold_minutes"),
                                   F.col("breach_threshold_minutes"))
    return measured.select(
        *measured.columns[:5],
        F.when(F.col("last_updated").isNull(), F.lit("missing")).otherwise(label).alias("status"),
        "age_minutes", ts(as_of).alias("created_ts"), ts(as_of).alias("updated_ts"),
    )


def within_warning(domain: str, last_updated: Column, as_of: str, slas: Mapping[str, Sla] = SLAS) -> Column:
    """Whether a domain whose latest load is ``last_updated`` is ok; without data it isn't."""
    age = whole_minutes_between(last_updated.cast("timestamp_ntz"), ts(as_of))
    label = labels.freshness_label(age, F.lit(slas[domain].warning_minutes), F.lit(slas[domain].breach_minutes))
    return F.coalesce(last_updated.isNotNull() & (label == "ok"), F.lit(False))


def refresh(tables: Mapping[str, DataFrame], as_of: str, slas: Mapping[str, Sla] = SLAS) -> DataFrame:
    """Status rows for the given domain tables; append them to the status history."""
    return status(latest_loads(tables), as_of, slas)


def current(history: DataFrame) -> DataFrame:
    """The latest status row per domain."""
    return first_per_key(history, ["domain"], [F.col("updated_ts").desc_nulls_last()])


def alerts(current_status: DataFrame, level: str = "breach") -> DataFrame:
    return current_status.filter(F.col("status") == level)


DETAIL = ("status", "age_minutes", "target_sla_minutes", "last_updated")


def summary(current_status: DataFrame, slas: Mapping[str, Sla] = SLAS) -> DataFrame:
    """One row: domains per status, then status, age, target and last update of every domain with a service level."""
    return current_status.agg(
        F.count("*").alias("total_domains"),
        *[F.count_if(F.col("status") == s).alias(f"{s}_domains") for s in ("ok", "warning", "breach", "missing")],
        *[F.max(F.when(F.col("domain") == d, F.col(c))).alias(f"{d}_{c}") for d in slas for c in DETAIL],
    )


def response(current_status: DataFrame) -> DataFrame:
    """One row with one struct per domain (last update, target, status)."""
    entry = F.struct(
        F.col("last_updated").alias("lastUpdated"), F.col("target_sla_minutes").alias("targetSlaMinutes"), "status"
    )
    return current_status.agg(*[
        F.max(F.when(F.col("domain") == d, entry)).alias(d) for d in SLAS
    ])


def breach_rows(current_status: DataFrame, as_of: str, within_minutes: int = 10) -> DataFrame:
    """Alert rows for breached domains, due within ``within_minutes`` of detection."""
    return alerts(current_status).select(
        F.lit("freshness").alias("alert_type"), F.col("domain").alias("subject"), F.lit("critical").alias("severity"),
        F.concat(F.lit("data is "), F.col("age_minutes").cast("string"), F.lit(" minutes old, limit "),
                 F.col("breach_threshold_minutes").cast("string")).alias("message"),
        ts(as_of).alias("detected_ts"),
        (ts(as_of) + F.make_dt_interval(mins=F.lit(within_minutes))).alias("due_ts"),
    )
