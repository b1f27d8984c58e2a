"""Publish gate: severity-graded checks over conformed tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stocktide.functions.timeexpr import ts
from stocktide.operators import freshness


@dataclass(frozen=True)
class Check:
    check_id: str
    name: str
    severity: str  # critical, warning or info
    dataset: str
    table: str
    column: str
    kind: str  # completeness, uniqueness, referential, non_negative, ordering, freshness, predicate
    description: str = ""
    current_only: bool = False
    references: tuple[str, str] | None = None  # (table, column)
    not_after: str | None = None  # ordering: column that must not come before ``column``
    violated: Column | None = None  # predicate: true where a row breaks the check


# The nine default checks.
DEFAULT_CHECKS: list[Check] = [
    Check("COMPL001", "Non-null key completeness", "critical", "silver", "supplier", "business_key", "completeness"),
    Check("COMPL002", "Non-null key completeness", "critical", "silver", "shipment", "shipment_id", "completeness"),
    Check("COMPL003", "Non-null key completeness", "critical", "silver", "inventory_position", "item_id",
          "completeness"),
    Check("UNIQ001", "Business key uniqueness", "critical", "silver", "supplier", "business_key", "uniqueness",
          current_only=True),
    Check("UNIQ002", "Shipment ID uniqueness", "critical", "silver", "shipment", "shipment_id", "uniqueness"),
    Check("REF001", "Supplier reference integrity", "critical", "silver", "shipment", "carrier_id", "referential",
          references=("supplier", "business_key")),
    Check("RANGE001", "Positive quantity values", "warning", "silver", "inventory_position", "quantity_on_hand",
          "non_negative"),
    Check("RANGE002", "Valid timestamp ordering", "warning", "silver", "shipment", "planned_departure_ts", "ordering",
          not_after="actual_departure_ts"),
    Check("FRESH001", "Data freshness", "warning", "silver", "*", "load_ts", "freshness"),
]

# Freshness domain of each conformed table.
DOMAIN_OF = {"supplier": "supplier", "shipment": "logistics", "inventory_position": "inventory"}

RESULT = [
    "check_id", "check_name", "severity", "dataset", "table_name", "column_name", "passed", "total_rows",
    "failing_rows", "message",
]


def checks_for(dataset: str, table: str, checks: Sequence[Check] = DEFAULT_CHECKS) -> list[Check]:
    """Checks that apply to a table; ``*`` matches anything."""
    return [c for c in checks if c.dataset in (dataset, "*") and c.table in (table, "*")]


def with_checks(*extra: Check, checks: Sequence[Check] = DEFAULT_CHECKS) -> list[Check]:
    return [*checks, *extra]


def orphans(df: DataFrame, column: str, referenced: DataFrame, key: str) -> DataFrame:
    """(value, rows) of references without a match; rows are counted before the anti join."""
    used = df.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).agg(F.count("*").alias("rows"))
    known = referenced.select(F.col(key).alias("value")).distinct()
    return used.join(known, "value", "left_anti")


def _wrong(check: Check) -> str:
    """What is said of the rows that fail a check."""
    if check.kind == "referential":
        return "without a counterpart in {}.{}".format(*check.references)
    texts = {"completeness": "without a value", "uniqueness": "repeated", "non_negative": "below zero", "ordering": f"later than {check.not_after}",
             "predicate": f"against {check.check_id}", "freshness": "overdue"}
    if check.kind not in texts:
        raise ValueError(f"Unknown check type: {check.kind}")
    return texts[check.kind]


def _outcome(check: Check, total: Column, failing: Column) -> Column:
    """The result row of a check as a struct."""
    message = F.concat(F.lit(f"{check.column}: "), failing.cast("string"), F.lit(" of "), total.cast("string"), F.lit(f" {_wrong(check)}"))
    return F.struct(
        F.lit(check.check_id).alias("check_id"), F.lit(check.name).alias("check_name"), F.lit(check.severity).alias("severity"),
        F.lit(check.dataset).alias("dataset"), F.lit(check.table).alias("table_name"), F.lit(check.column).alias("column_name"),
        (failing == 0).alias("passed"), total.cast("bigint").alias("total_rows"), failing.cast("bigint").alias("failing_rows"),
        message.alias("message"))


def _counters(check: Check, as_of: str | None) -> tuple[Column, Column] | None:
    """Aggregates (total, failing) of a check that a scan can answer without grouping; None for the others."""
    c = F.col(check.column)
    if check.kind == "completeness":
        return F.count("*"), F.count_if(c.isNull())
    if check.kind == "non_negative":
        return F.count(c), F.count_if(c < 0)
    if check.kind == "ordering":
        return F.count(c), F.count_if(c > F.col(check.not_after))
    if check.kind == "predicate":
        return F.count("*"), F.count_if(check.violated)
    if check.kind == "freshness":
        return F.lit(1), F.when(freshness.within_warning(DOMAIN_OF[check.table], F.max(c), as_of), 0).otherwise(1)
    _wrong(check)
    return None


def _grouped(df: DataFrame, column: str, checks: Sequence[Check], tables: Mapping[str, DataFrame]) -> DataFrame:
    """Result rows of the uniqueness and reference checks of one column, from one grouping of it."""
    v = F.col(column)
    current = F.count_if("is_current") if any(c.current_only for c in checks) else F.count("*")
    groups = df.groupBy(v.alias("v")).agg(F.count("*").alias("n"), current.alias("current"))
    outcomes = []
    for i, check in enumerate(checks):
        n = F.col("current") if check.current_only else F.col("n")
        if check.kind == "uniqueness":
            total = F.coalesce(F.sum(n), F.lit(0))
            outcomes.append(_outcome(check, total, total - F.count_if(F.col("v").isNotNull() & (n > 0))))
        else:
            table, key = check.references
            known = tables[table].select(F.col(key).alias("v")).where("v is not null").distinct().withColumn(f"hit{i}", F.lit(True))
            groups = groups.join(known, "v", "left")
            used = F.col("v").isNotNull()
            outcomes.append(_outcome(check, F.coalesce(F.sum(F.when(used, n)), F.lit(0)),
                                     F.coalesce(F.sum(F.when(used & F.col(f"hit{i}").isNull(), n)), F.lit(0))))
    return groups.agg(F.array(*outcomes).alias("r")).select(F.inline("r"))


def run_checks(
    spark: SparkSession, dataset: str, table: str, tables: Mapping[str, DataFrame], as_of: str | None = None,
    checks: Sequence[Check] | None = None,
) -> DataFrame:
    """Result rows of every check that applies to the table.

    All checks that look at rows by themselves are counters of one aggregate, and those that compare the values of a column
    share one grouping of it: the table is read once for the former and once per column for the latter, however many checks
    there are. A check that cannot be set up (missing column or table) is a failed check.
    """
    todo = [Check(**{**c.__dict__, "table": table}) for c in (checks if checks is not None else checks_for(dataset, table))]
    if not todo:
        raise ValueError(f"no checks apply to {dataset}.{table}")
    df, failed, single, by_column = tables.get(table), [], [], {}
    for check in todo:
        needed = [c for c in (check.column, check.not_after) if c]
        absent = [f"table {table}"] if df is None else [f"column {c}" for c in needed if c not in df.columns]
        if df is not None and check.references and not absent:
            other, key = check.references
            absent = [f"table {other}"] if other not in tables else [] if key in tables[other].columns else [f"column {key}"]
        try:
            if absent:
                raise KeyError(f"{absent[0]} not found")
            counters = _counters(check, as_of)
        except (KeyError, ValueError) as error:
            failed.append((check, f"could not be run: {error}"))
            continue
        if counters:
            single.append((check, counters))
        else:
            by_column.setdefault(check.column, []).append(check)
    parts = []
    if single:
        counted = df.agg(*[c.alias(f"{k}{i}") for i, (_, pair) in enumerate(single) for k, c in zip("tf", pair)])
        rows = F.array(*[_outcome(check, F.col(f"t{i}"), F.col(f"f{i}")) for i, (check, _) in enumerate(single)])
        parts.append(counted.select(F.inline(rows)))
    parts += [_grouped(df, column, group, tables) for column, group in by_column.items()]
    if failed:
        rows = F.array(*[F.struct(
            F.lit(c.check_id).alias("check_id"), F.lit(c.name).alias("check_name"), F.lit(c.severity).alias("severity"), F.lit(c.dataset).alias("dataset"),
            F.lit(c.table).alias("table_name"), F.lit(c.column).alias("column_name"), F.lit(False).alias("passed"),
            F.lit(None).cast("bigint").alias("total_rows"), F.lit(None).cast("bigint").alias("failing_rows"), F.lit(m).alias("message"))
            for c, m in failed])
        parts.append(spark.range(1).select(F.inline(rows)))
    return reduce(DataFrame.unionByName, parts)


def run_check(
    spark: SparkSession, check: Check, table: str, tables: Mapping[str, DataFrame], as_of: str | None = None
) -> DataFrame:
    """The result row of one check."""
    return run_checks(spark, check.dataset, table, tables, as_of, [check])


def evaluate(results: DataFrame, dataset: str, table: str, as_of: str) -> DataFrame:
    """The gate-log row: BLOCKED on any critical failure, else OPEN."""
    def failures(severity: str) -> Column:
        return F.count_if(~F.col("passed") & (F.col("severity") == severity)).cast("int")

    counted = results.agg(
        F.count("*").cast("int").alias("total_checks"),
        F.count_if("passed").cast("int").alias("passed_checks"),
        F.count_if(~F.col("passed")).cast("int").alias("failed_checks"),
        failures("critical").alias("critical_failures"),
        failures("warning").alias("warning_failures"),
        failures("info").alias("info_failures"),
    )
    critical, warning, info = (F.col(f"{s}_failures") for s in ("critical", "warning", "info"))
    at = ts(as_of)
    return counted.select(
        F.concat_ws("_", F.lit(dataset), F.lit(table), F.date_format(at, "yyyyMMdd_HHmmss")).alias("evaluation_id"),
        F.lit(dataset).alias("dataset"), F.lit(table).alias("table_name"),
        F.when(critical > 0, F.lit("blocked")).otherwise(F.lit("open")).alias("status"),
        (critical == 0).alias("can_publish"),
        "total_checks", "passed_checks", "failed_checks", "critical_failures", "warning_failures", "info_failures",
        at.alias("evaluation_time"),
        F.when(critical > 0, F.concat(F.lit("closed: critical checks failed: "), critical.cast("string")))
        .when(warning + info > 0, F.concat(F.lit("open, to be looked at: warnings "), warning.cast("string"), F.lit(", infos "), info.cast("string")))
        .otherwise(F.lit("open")).alias("message"),
        at.alias("created_ts"),
    )


def history(log: DataFrame, limit: int = 100, **equals: str) -> DataFrame:
    """Newest log rows (gate or validation log), filtered by column values; a top-``limit`` report."""
    time = "evaluation_time" if "evaluation_time" in log.columns else "validation_time"
    for column, value in equals.items():
        log = log.filter(F.col(column) == value)
    return log.orderBy(F.col(time).desc(), *sorted(c for c in log.columns if c != time)).limit(limit)


def definitions(spark: SparkSession, checks: Sequence[Check] = DEFAULT_CHECKS) -> DataFrame:
    rows = [(c.check_id, c.name, c.severity, c.dataset, c.table, c.column, c.kind) for c in checks]
    return spark.createDataFrame(
        rows, "check_id string, check_name string, severity string, dataset string, table_name string, "
              "column_name string, kind string")


def check_summary(spark: SparkSession, checks: Sequence[Check] = DEFAULT_CHECKS) -> DataFrame:
    """Number of checks per severity and dataset."""
    return definitions(spark, checks).groupBy("severity", "dataset").agg(F.count("*").alias("checks"))


def dq_response(results: DataFrame) -> DataFrame:
    """Per dataset: whether all critical checks passed, and the failed checks as an array of structs.

    The arrays hold at most one element per check definition.
    """
    failed = F.when(~F.col("passed"), F.struct(F.col("check_id").alias("checkId"), "severity", "message"))
    return results.groupBy(F.concat_ws(".", "dataset", "table_name").alias("dataset")).agg(
        (F.count_if(~F.col("passed") & (F.col("severity") == "critical")) == 0).alias("criticalChecksPassed"),
        F.sort_array(F.collect_list(failed)).alias("failedChecks"),
    )


def dq_status_rows(results: DataFrame, as_of: str) -> DataFrame:
    """Rows of the check-status table."""
    return results.select(
        F.concat_ws(".", "dataset", "table_name").alias("dataset"), "check_id",
        F.col("passed").alias("check_result"), "severity", "message", ts(as_of).alias("check_ts"),
    )


def alert_rows(results: DataFrame, as_of: str, within_minutes: int = 10) -> DataFrame:
    """Alert rows for failed critical checks."""
    return results.filter(~F.col("passed") & (F.col("severity") == "critical")).select(
        F.lit("data_quality").alias("alert_type"), F.concat_ws(".", "dataset", "table_name").alias("subject"),
        "severity", "message", ts(as_of).alias("detected_ts"),
        (ts(as_of) + F.make_dt_interval(mins=F.lit(within_minutes))).alias("due_ts"),
    )


def table_status(results: DataFrame, score: DataFrame, table: str, as_of: str) -> DataFrame:
    """The data-quality status row of a table: verdict of its checks next to its quality score.

    Check rows and the one-row score meet in one aggregate.
    """
    checks = results.selectExpr(
        "NOT passed AND severity = 'critical' AS critical", "NOT passed AS failed", "check_id", "CAST(NULL AS DOUBLE) AS score")
    scores = score.selectExpr("false AS critical", "false AS failed", "CAST(NULL AS STRING) AS check_id",
                              "quality_score AS score")
    at = ts(as_of)
    return checks.unionByName(scores).agg(
        (F.count_if("critical") == 0).alias("critical_checks_passed"),
        F.count_if("failed").cast("int").alias("failed_checks_count"),
        F.max("score").alias("quality_score"),
        F.array_join(F.sort_array(F.collect_list(F.when(F.col("failed"), F.col("check_id")))), ",").alias("details"),
    ).select(F.lit(table).alias("table_name"), at.alias("check_timestamp"), "critical_checks_passed",
             "failed_checks_count", "quality_score", "details", at.alias("created_ts"))
