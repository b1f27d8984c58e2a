"""Data-quality measurements: one scan per table, counts instead of collected rows."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stocktide.functions import labels

# Penalty caps and pass mark of the quality score.
NULL_CAP, DUPLICATE_CAP, CONSTRAINT_CAP, PASS_MARK = 0.3, 0.2, 0.5, 0.8

_NUMERIC = {"double", "int", "bigint", "float"}
_STOCK_COLUMNS = ["quantity_on_hand", "safety_stock", "in_transit_qty"]


def _constraints(df: DataFrame, table: str) -> dict[str, Column]:
    """Violation predicates: negatives in numeric columns plus the rules of the table's domain."""
    rules = {f"{f.name}_negative": F.col(f.name) < 0 for f in df.schema.fields if f.dataType.simpleString() in _NUMERIC}
    name, columns = table.lower(), set(df.columns)
    if "supplier" in name:
        if "status" in columns:
            rules["invalid_status"] = ~F.col("status").isin(labels.SUPPLIER_STATUSES)
    elif "inventory" in name:
        rules.update({f"{c}_negative": F.col(c) < 0 for c in _STOCK_COLUMNS if c in columns})
    elif "shipment" in name:
        if "status" in columns:
            rules["invalid_status"] = ~F.col("status").isin(labels.SHIPMENT_STATUSES)
        if {"planned_departure_ts", "planned_arrival_ts"} <= columns:
            rules["invalid_timestamps"] = F.col("planned_departure_ts") > F.col("planned_arrival_ts")
    return rules


def _as_rows(one_row: DataFrame, names: Sequence[str], prefix: str, label: str, count: str) -> DataFrame:
    """A one-row frame of ``prefix + name`` counters to (label, count) rows, zeros left out."""
    pairs = F.array(*[F.struct(F.lit(n).alias(label), F.col(f"{prefix}{n}").alias(count)) for n in names])
    return one_row.select(F.inline(pairs)).filter(F.col(count) > 0)


def null_counts(df: DataFrame) -> DataFrame:
    """Columns with nulls: (column_name, null_count)."""
    counters = df.agg(*[F.count_if(F.col(c).isNull()).alias(f"n_{c}") for c in df.columns])
    return _as_rows(counters, df.columns, "n_", "column_name", "null_count")


def constraint_counts(df: DataFrame, table: str) -> DataFrame:
    """Violated rules: (rule, violations)."""
    rules = _constraints(df, table)
    if not rules:
        return df.sparkSession.createDataFrame([], "rule string, violations bigint")
    counters = df.agg(*[F.count_if(p).alias(f"v_{n}") for n, p in rules.items()])
    return _as_rows(counters, list(rules), "v_", "rule", "violations")


def negative_counts(df: DataFrame) -> DataFrame:
    """Numeric columns with negative values: (rule, violations)."""
    return constraint_counts(df, "")


#: Predicates whose outcomes one number holds.
_PER_NUMBER = 60
DIGEST = ["_da", "_db"]


def _predicates(df: DataFrame, table: str) -> dict[str, Column]:
    """What is counted of every row: nulls by column (``n_``), broken rules (``v_``)."""
    return {f"n_{c}": F.col(c).isNull() for c in df.columns} | {f"v_{n}": p for n, p in _constraints(df, table).items()}


def row_groups(df: DataFrame, table: str | None = None) -> DataFrame:
    """Equal rows as one: 128-bit digest, outcomes of the predicates of ``table`` and how many rows there are (``_n``).

    Rows travel as these few numbers, not as keys of all their columns. The digest is two 64-bit hashes of other order over
    all values and of which are null; by chance two different rows of 10^12 share one with probability below 10^-14.
    """
    predicates = _predicates(df, table) if table is not None else {}
    # 0.0 and -0.0 are equal, also as keys of a group
    values = [F.col(f.name) + F.lit(0.0) if f.dataType.simpleString() in ("double", "float") else F.col(f.name) for f in df.schema.fields]
    nulls = F.concat(F.lit(""), *[F.when(F.col(c).isNull(), F.lit("1")).otherwise(F.lit("0")) for c in df.columns])
    marks = []
    names = list(predicates)
    for k in range(0, len(names), _PER_NUMBER):
        bits = [F.when(F.coalesce(predicates[n], F.lit(False)), F.lit(1 << i).cast("bigint")).otherwise(F.lit(0).cast("bigint"))
                for i, n in enumerate(names[k : k + _PER_NUMBER])]
        marks.append(reduce(lambda a, b: a.bitwiseOR(b), bits).alias(f"_f{k // _PER_NUMBER}"))
    rows = df.select(F.xxhash64(nulls, *values).alias(DIGEST[0]), F.xxhash64(F.lit("b"), *reversed(values), nulls).alias(DIGEST[1]), *marks)
    return rows.groupBy(*rows.columns).agg(F.count("*").alias("_n"))


def row_counters(df: DataFrame, table: str) -> dict[str, Column]:
    """Aggregates over ``row_groups`` of a table: ``total``, and rows by predicate."""
    n = F.col("_n")
    out = {"total": F.coalesce(F.sum(n), F.lit(0))}
    for i, name in enumerate(_predicates(df, table)):
        hit = F.col(f"_f{i // _PER_NUMBER}").bitwiseAND(F.lit(1 << i % _PER_NUMBER).cast("bigint")) != 0
        out[name] = F.coalesce(F.sum(F.when(hit, n)), F.lit(0))
    return out


def duplicate_rows(df: DataFrame) -> DataFrame:
    """One row: total, distinct and duplicate whole rows and the duplicate rate."""
    return row_groups(df).agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("total_records"), F.count("*").alias("distinct_records")
    ).select(
        "total_records", "distinct_records",
        (F.col("total_records") - F.col("distinct_records")).alias("duplicate_count"),
        F.coalesce(F.try_divide(F.col("total_records") - F.col("distinct_records"), F.col("total_records")),
                   F.lit(0.0)).alias("duplicate_rate"),
    )


def quality_score(df: DataFrame, table: str) -> DataFrame:
    """One row: record count, penalties, score and verdict.

    Equal rows are grouped first, by digest; nulls and violations are counted on the distinct rows with their multiplicity, so
    the table is scanned once and shuffled as digests.
    The mean null (violation) share is taken over the columns (rules) that fail.
    """
    counters = row_counters(df, table)
    return score_of(row_groups(df, table).agg(*[c.alias(n) for n, c in counters.items()], F.count("*").alias("uniq")), table)


def score_of(counted: DataFrame, table: str) -> DataFrame:
    """The score from one row of counters: ``total``, ``uniq``, nulls by column (``n_``) and broken rules (``v_``)."""

    def penalty(prefix: str, cap: float) -> Column:
        counters = [F.col(c) for c in counted.columns if c.startswith(prefix)]
        if not counters:
            return F.lit(0.0)
        failing = reduce(lambda a, b: a + b, [(c > 0).cast("int") for c in counters])
        total = reduce(lambda a, b: a + b, counters)
        return F.least(F.coalesce(F.try_divide(total, F.col("total") * failing), F.lit(0.0)), F.lit(cap))

    scored = counted.select(
        F.lit(table).alias("table_name"),
        F.col("total").alias("total_records"),
        (F.col("total") - F.col("uniq")).alias("duplicate_count"),
        penalty("n_", NULL_CAP).alias("null_penalty"),
        F.least(F.coalesce(F.try_divide(F.col("total") - F.col("uniq"), F.col("total")), F.lit(0.0)),
                F.lit(DUPLICATE_CAP)).alias("duplicate_penalty"),
        penalty("v_", CONSTRAINT_CAP).alias("constraint_penalty"),
    )
    score = F.greatest(
        F.lit(1.0) - F.col("null_penalty") - F.col("duplicate_penalty") - F.col("constraint_penalty"), F.lit(0.0)
    )
    return scored.withColumn(
        "quality_score", F.when(F.col("total_records") == 0, F.lit(0.0)).otherwise(score)
    ).withColumn("is_valid", F.col("quality_score") >= PASS_MARK)


# --- conformed tables -----------------------------------------------------------------------------------


def supplier_checks(dim: DataFrame) -> DataFrame:
    """One row over the supplier history: blank keys, keys with several current rows, reversed ranges, totals."""
    per_key = dim.groupBy("business_key").agg(
        F.count("*").alias("n"),
        F.count_if(F.col("is_current")).alias("open_rows"),
        F.count_if(F.col("effective_start_ts") > F.col("effective_end_ts")).alias("reversed"),
    )
    blank = labels.is_blank(F.col("business_key"))
    return per_key.agg(
        F.coalesce(F.sum(F.when(blank, F.col("n"))), F.lit(0)).alias("orphaned_records"),
        F.count_if(F.col("open_rows") > 1).alias("duplicate_current"),
        F.coalesce(F.sum("reversed"), F.lit(0)).alias("invalid_date_ranges"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_records"),
        F.coalesce(F.sum("open_rows"), F.lit(0)).alias("current_records"),
    )


def shipment_checks(shipments: DataFrame) -> DataFrame:
    """One row over shipments: blank ids, invalid statuses, reversed plans, totals."""
    return shipments.agg(
        F.count_if(labels.is_blank(F.col("shipment_id"))).alias("missing_shipment_id"),
        F.count_if(labels.is_blank(F.col("carrier_id"))).alias("missing_carrier_id"),
        F.count_if(~F.col("status").isin(labels.SHIPMENT_STATUSES)).alias("invalid_status"),
        F.count_if(F.col("planned_departure_ts") > F.col("planned_arrival_ts")).alias("invalid_timestamps"),
        F.count("*").alias("total_records"),
        F.count_if(F.col("status") == "in_transit").alias("active_shipments"),
    )


def inventory_checks(inventory: DataFrame) -> DataFrame:
    """One row over inventory: blank ids, negatives, repeated snapshots, totals, distinct items and locations.

    Grouped by snapshot first, so that the distinct counts run over one row per snapshot.
    """
    negative = reduce(lambda a, b: a | b, [F.coalesce(F.col(c) < 0, F.lit(False)) for c in _STOCK_COLUMNS])
    per_snapshot = inventory.groupBy("item_id", "location_id", "snapshot_date").agg(
        F.count("*").alias("n"), F.count_if(negative).alias("neg")
    )

    def total(predicate: Column) -> Column:
        return F.coalesce(F.sum(F.when(predicate, F.col("n"))), F.lit(0))

    return per_snapshot.agg(
        total(labels.is_blank(F.col("item_id"))).alias("missing_item_id"),
        total(labels.is_blank(F.col("location_id"))).alias("missing_location_id"),
        F.coalesce(F.sum("neg"), F.lit(0)).alias("negative_quantities"),
        F.count_if(F.col("n") > 1).alias("duplicate_snapshots"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_records"),
        F.count_distinct("item_id").alias("unique_items"),
        F.count_distinct("location_id").alias("unique_locations"),
    )


# Counters that must be zero before a conformed table is accepted.
ACCEPTANCE = {
    "supplier": ["orphaned_records", "duplicate_current"],
    "shipment": ["missing_shipment_id", "invalid_status"],
    "inventory": ["missing_item_id", "negative_quantities"],
}


def accepted(checks: DataFrame, domain: str) -> DataFrame:
    """One row (domain, accepted) from a domain's check row."""
    clean = reduce(lambda a, b: a & b, [F.col(c) == 0 for c in ACCEPTANCE[domain]])
    return checks.select(F.lit(domain).alias("domain"), clean.alias("accepted"))


# --- gold checks -----------------------------------------------------------------------------------------

_GOLD = ["check_name", "record_count", "missing_count", "invalid_count", "critical_failures", "status"]


def _gold_row(one_row: DataFrame, name: str) -> DataFrame:
    bad = F.col("missing_count") + F.col("invalid_count")
    return one_row.withColumns({
        "check_name": F.lit(name),
        "critical_failures": bad,
        "status": F.when(bad == 0, F.lit("PASS")).otherwise(F.lit("FAIL")),
    }).select(*_GOLD)


def gold_unified_check(unified: DataFrame, literal_key: bool = False) -> DataFrame:
    """Rows, rows with a missing key, and repeated keys (per shipment; without it in the literal form)."""
    key = ["product_id", "location_id", "supplier_id", "inventory_date"]
    if not literal_key:
        key += ["item_id", "shipment_id"]
    per_key = unified.groupBy(*key).agg(F.count("*").alias("n"))
    orphan = F.col("product_id").isNull() | F.col("location_id").isNull() | F.col("supplier_id").isNull()
    return _gold_row(
        per_key.agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("record_count"),
            F.coalesce(F.sum(F.when(orphan, F.col("n"))), F.lit(0)).alias("missing_count"),
            F.count_if(F.col("n") > 1).alias("invalid_count"),
        ),
        "unified_supply_chain",
    )


def gold_supplier_check(dim: DataFrame) -> DataFrame:
    """Current suppliers: blank names, repeated business keys."""
    per_key = dim.filter("is_current").groupBy("business_key").agg(
        F.count("*").alias("n"), F.count_if(labels.is_blank(F.col("name"))).alias("blank")
    )
    return _gold_row(
        per_key.agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("record_count"),
            F.coalesce(F.sum("blank"), F.lit(0)).alias("missing_count"),
            F.count_if(F.col("n") > 1).alias("invalid_count"),
        ),
        "supplier_data",
    )


def gold_inventory_check(inventory: DataFrame) -> DataFrame:
    negative = reduce(lambda a, b: a | b, [F.coalesce(F.col(c) < 0, F.lit(False)) for c in _STOCK_COLUMNS])
    missing = F.col("item_id").isNull() | F.col("location_id").isNull() | F.col("snapshot_date").isNull()
    return _gold_row(
        inventory.agg(
            F.count("*").alias("record_count"), F.count_if(missing).alias("missing_count"),
            F.count_if(negative).alias("invalid_count"),
        ),
        "inventory_data",
    )


def gold_shipment_check(shipments: DataFrame) -> DataFrame:
    missing = F.col("shipment_id").isNull() | F.col("carrier_id").isNull() | F.col("status").isNull()
    return _gold_row(
        shipments.agg(
            F.count("*").alias("record_count"), F.count_if(missing).alias("missing_count"),
            F.count_if(~F.col("status").isin(labels.SHIPMENT_STATUSES)).alias("invalid_count"),
        ),
        "shipment_data",
    )


def gold_checks(unified: DataFrame, suppliers: DataFrame, inventory: DataFrame, shipments: DataFrame) -> DataFrame:
    """The four gold checks, one row each."""
    return (
        gold_unified_check(unified)
        .unionByName(gold_supplier_check(suppliers))
        .unionByName(gold_inventory_check(inventory))
        .unionByName(gold_shipment_check(shipments))
    )


def overall_status(checks: DataFrame) -> DataFrame:
    """One row: FAIL when any gold check has a critical failure, and how many checks failed."""
    failed = F.count_if(F.col("critical_failures") > 0)
    return checks.agg(failed.alias("failed_checks"), F.count("*").alias("total_checks")).withColumn(
        "overall_status", F.when(F.col("failed_checks") == 0, F.lit("PASS")).otherwise(F.lit("FAIL"))
    )


# --- row rules -------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class RowRule:
    """A rule over rows; ``violated`` is true where a row breaks it."""

    check_id: str
    severity: str  # info, warning or critical
    message: str
    violated: Column


def non_negative(column: str, check_id: str) -> RowRule:
    return RowRule(check_id, "critical", "Value must be non-negative", F.col(column) < 0)


def run_rules(df: DataFrame, rules: Sequence[RowRule], keys: Sequence[str]) -> DataFrame:
    """Every broken rule of every row: keys, check_id, severity, message."""
    failed = F.array_compact(F.array(*[
        F.when(r.violated, F.struct(F.lit(r.check_id).alias("check_id"), F.lit(r.severity).alias("severity"),
                                    F.lit(r.message).alias("message")))
        for r in rules
    ]))
    return df.select(*keys, F.explode(failed).alias("f")).select(*keys, "f.*")


def may_publish(failures: DataFrame) -> DataFrame:
    """One row: publication is allowed unless a critical failure exists."""
    return failures.agg(
        (F.count_if(F.col("severity") == "critical") == 0).alias("can_publish"), F.count("*").alias("failures")
    )


def rates(unified: DataFrame, inventory: DataFrame, freshness: DataFrame) -> DataFrame:
    """One row of ratios: key completeness, snapshot uniqueness, orphan share, SLA compliance."""
    complete = unified.agg(
        F.avg((F.col("product_id").isNotNull() & F.col("location_id").isNotNull()).cast("double"))
        .alias("completeness_rate"),
        F.avg(F.col("supplier_id").isNull().cast("double")).alias("orphan_rate"),
    )
    per_snapshot = inventory.groupBy("item_id", "location_id", "snapshot_date").agg(F.count("*").alias("n"))
    unique = per_snapshot.agg((F.count("*") / F.sum("n")).alias("uniqueness_rate"))
    sla = freshness.agg(F.avg((F.col("status") != "breach").cast("double")).alias("sla_compliance_rate"))

    def named(one_row: DataFrame) -> DataFrame:
        return one_row.select(F.inline(F.array(*[
            F.struct(F.lit(c).alias("rate"), F.col(c).alias("value")) for c in one_row.columns
        ])))

    return named(complete).unionByName(named(unique)).unionByName(named(sla))
