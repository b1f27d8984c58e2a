"""Status labels and small derived values used by several operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Label vocabularies, in the order (zero stock, at or below safety stock, above).
STOCK_LEVEL = ("stockout", "at_risk", "healthy")
RISK_LOWER = ("immediate", "high", "low")
RISK_UPPER = ("IMMEDIATE", "HIGH", "LOW")

# Status domains.
SUPPLIER_STATUSES = ["active", "inactive", "pending", "suspended"]
SHIPMENT_STATUSES = ["planned", "in_transit", "delivered", "cancelled"]


def stock_label(quantity: Column, safety: Column, labels: tuple[str, str, str] = STOCK_LEVEL) -> Column:
    """Zero stock first, then at or below the safety level, then the rest."""
    empty, low, fine = labels
    return F.when(quantity == 0, F.lit(empty)).when(quantity <= safety, F.lit(low)).otherwise(F.lit(fine))


def stock_label_safety_first(quantity: Column, safety: Column) -> Column:
    """The safety-level test comes first, so zero stock is ``at_risk`` unless safety is null or negative."""
    empty, low, fine = STOCK_LEVEL
    return F.when(quantity <= safety, F.lit(low)).when(quantity == 0, F.lit(empty)).otherwise(F.lit(fine))


def performance_score(rate: Column) -> Column:
    """Score 5 to 1 from a delivery rate."""
    return (
        F.when(rate >= 0.9, F.lit(5.0))
        .when(rate >= 0.8, F.lit(4.0))
        .when(rate >= 0.7, F.lit(3.0))
        .when(rate >= 0.6, F.lit(2.0))
        .otherwise(F.lit(1.0))
    )


def share_where(condition: Column) -> Column:
    """Aggregate: share of rows where the condition holds, NULL counted as not holding."""
    return F.avg(F.when(condition, F.lit(1.0)).otherwise(F.lit(0.0)))


def is_blank(c: Column) -> Column:
    return c.isNull() | (c == "")


def freshness_label(age_minutes: Column, warning: Column, breach: Column) -> Column:
    return (
        F.when(age_minutes <= warning, F.lit("ok"))
        .when(age_minutes <= breach, F.lit("warning"))
        .otherwise(F.lit("breach"))
    )


def delay_days(planned_arrival: Column, actual_arrival: Column) -> Column:
    """Calendar days late (positive) or early (negative); NULL unless both times are known."""
    return F.datediff(actual_arrival, planned_arrival)


def delivered_flag(status: Column, actual_arrival: Column) -> Column:
    return F.coalesce((status == "delivered") & actual_arrival.isNotNull(), F.lit(False))
