"""Registered queries: data quality, publish gate, freshness, contracts, late data and governance."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stocktide.functions.timeexpr import ts
from stocktide.operators import contracts, freshness, gate, governance as gov, inventory as inv, late, quality as dq
from stocktide.operators import shipments as shp
from stocktide.plans.ctes import AS_OF
from stocktide.plans.queries import rounded, silver_inventory, silver_shipments, supplier_dim, unified_whole
from stocktide.plans.quality_state import QualityState
from stocktide.plans.registry import query
from stocktide.session import scratch_dir
from stocktide.sources.store import Store

SHIPMENT_COLUMNS = ("shipment_id route_id carrier_id origin destination planned_departure_ts actual_departure_ts "
                    "planned_arrival_ts actual_arrival_ts status load_ts source_system").split()
INVENTORY_COLUMNS = ("item_id location_id snapshot_date quantity_on_hand safety_stock in_transit_qty load_ts "
                     "source_system").split()

# --- table quality -----------------------------------------------------------------------------------------


def _null_sql(table: str, columns: list[str]) -> str:
    parts = [f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS null_count FROM {table}"
             for c in columns]
    return "SELECT * FROM (" + " UNION ALL ".join(parts) + ") WHERE null_count > 0"


@query("dq_nulls", using="fx_shipment", check=_null_sql("fx_shipment", SHIPMENT_COLUMNS))
def _(t):
    return dq.null_counts(t.shipment_feed())


@query("dq_nulls_inventory", using="fx_inventory", check=_null_sql("fx_inventory", INVENTORY_COLUMNS))
def _(t):
    return dq.null_counts(t.inventory_feed())


@query("dq_duplicates", using="fx_shipment", check="""
SELECT n AS total_records, d AS distinct_records, n - d AS duplicate_count, round((n - d) / n::DOUBLE, 6) AS duplicate_rate
FROM (SELECT (SELECT count(*) FROM fx_shipment) AS n, (SELECT count(*) FROM (SELECT DISTINCT * FROM fx_shipment)) AS d)""")
def _(t):
    return rounded(dq.duplicate_rows(t.shipment_feed()), "duplicate_rate")


_INVENTORY_RULES = {c + "_negative": f"{c} < 0" for c in ("quantity_on_hand", "safety_stock", "in_transit_qty")}
_SHIPMENT_RULES = {
    "invalid_status": "status NOT IN ('planned', 'in_transit', 'delivered', 'cancelled')",
    "invalid_timestamps": "planned_departure_ts > planned_arrival_ts",
}


def _rule_sql(table: str, rules: dict[str, str]) -> str:
    parts = [f"SELECT '{n}' AS rule, count(*) FILTER (WHERE {p}) AS violations FROM {table}" for n, p in rules.items()]
    return "SELECT * FROM (" + " UNION ALL ".join(parts) + ") WHERE violations > 0"


@query("dq_negatives", using="fx_inventory", check=_rule_sql("fx_inventory", _INVENTORY_RULES))
def _(t):
    return dq.negative_counts(t.inventory_feed())


@query("dq_constraints", using="fx_shipment", check=_rule_sql("fx_shipment", _SHIPMENT_RULES))
def _(t):
    return dq.constraint_counts(t.shipment_feed(), "silver.shipment")


@query("dq_constraints_supplier", using="fx_supplier_feed", check=_rule_sql(
    "(SELECT *, CASE WHEN region IS NULL THEN 'unknown' ELSE status END AS state FROM fx_supplier_feed)",
    {"invalid_status": "state NOT IN ('active', 'inactive', 'pending', 'suspended')"}))
def _(t):
    feed = t.supplier_feed().withColumn("status", F.when(F.col("region").isNull(), "unknown").otherwise(F.col("status")))
    return dq.constraint_counts(feed, "silver.supplier_scd2")


def _score_sql(table: str, columns: list[str], rules: dict[str, str]) -> str:
    nulls = ", ".join(f"count(*) FILTER (WHERE {c} IS NULL) AS n_{c}" for c in columns)
    breaks = ", ".join(f"count(*) FILTER (WHERE {p}) AS v_{n}" for n, p in rules.items())
    null_sum, null_cols = "+".join(f"n_{c}" for c in columns), "+".join(f"(n_{c} > 0)::INT" for c in columns)
    rule_sum, rule_cols = "+".join(f"v_{n}" for n in rules), "+".join(f"(v_{n} > 0)::INT" for n in rules)
    return f"""
SELECT '{table}' AS table_name, total AS total_records, total - uniq AS duplicate_count,
       round(np, 6) AS null_penalty, round(dp, 6) AS duplicate_penalty, round(cp, 6) AS constraint_penalty,
       round(greatest(1.0 - np - dp - cp, 0.0), 6) AS quality_score, greatest(1.0 - np - dp - cp, 0.0) >= 0.8 AS is_valid
FROM (SELECT total, uniq,
             least(coalesce(({null_sum}) / (total * nullif({null_cols}, 0))::DOUBLE, 0.0), 0.3::DOUBLE) AS np,
             least((total - uniq) / total::DOUBLE, 0.2::DOUBLE) AS dp,
             least(coalesce(({rule_sum}) / (total * nullif({rule_cols}, 0))::DOUBLE, 0.0), 0.5::DOUBLE) AS cp
      FROM (SELECT count(*) AS total, {nulls}, {breaks} FROM {table}),
           (SELECT count(*) AS uniq FROM (SELECT DISTINCT * FROM {table})))"""


@query("dq_score", using="fx_shipment", check=_score_sql("fx_shipment", SHIPMENT_COLUMNS, _SHIPMENT_RULES))
def _(t):
    return rounded(dq.quality_score(t.shipment_feed(), "fx_shipment"), "null_penalty", "duplicate_penalty",
                   "constraint_penalty", "quality_score")


@query("dq_score_incremental", using="fx_shipment", check=_score_sql("fx_shipment", SHIPMENT_COLUMNS, _SHIPMENT_RULES))
def _(t):
    """The score of shipments that came in three batches, from what each of them brought."""
    state = QualityState(Store(t.spark, scratch_dir(t.spark, "quality"), buckets=8), "fx_shipment")
    for number in (1, 2, 3):
        state.add(t.shipment_feed().where(F.pmod(F.xxhash64("shipment_id", "status"), F.lit(3)) == number - 1), number)
    return rounded(state.score(), "null_penalty", "duplicate_penalty", "constraint_penalty", "quality_score")


@query("dq_score_inventory", using="fx_inventory",
       check=_score_sql("fx_inventory", INVENTORY_COLUMNS, _INVENTORY_RULES))
def _(t):
    return rounded(dq.quality_score(t.inventory_feed(), "fx_inventory"), "null_penalty", "duplicate_penalty",
                   "constraint_penalty", "quality_score")


_SUPPLIER_CHECKS = """
SELECT count(*) FILTER (WHERE business_key IS NULL OR business_key = '') AS orphaned_records,
       (SELECT count(*) FROM (SELECT business_key FROM dim_supplier WHERE is_current GROUP BY 1 HAVING count(*) > 1))
         AS duplicate_current,
       count(*) FILTER (WHERE effective_start_ts > effective_end_ts) AS invalid_date_ranges,
       count(*) AS total_records, count(*) FILTER (WHERE is_current) AS current_records
FROM dim_supplier"""


@query("dq_supplier", using="dim_supplier", check=_SUPPLIER_CHECKS)
def _(t):
    return dq.supplier_checks(supplier_dim(t))


_SHIPMENT_CHECKS = """
SELECT count(*) FILTER (WHERE shipment_id IS NULL OR shipment_id = '') AS missing_shipment_id,
       count(*) FILTER (WHERE carrier_id IS NULL OR carrier_id = '') AS missing_carrier_id,
       count(*) FILTER (WHERE status NOT IN ('planned', 'in_transit', 'delivered', 'cancelled')) AS invalid_status,
       count(*) FILTER (WHERE planned_departure_ts > planned_arrival_ts) AS invalid_timestamps,
       count(*) AS total_records, count(*) FILTER (WHERE status = 'in_transit') AS active_shipments
FROM {source}"""


@query("dq_shipment", using="fx_shipment", check=_SHIPMENT_CHECKS.format(source="fx_shipment"))
def _(t):
    return dq.shipment_checks(t.shipment_feed())


_INVENTORY_CHECKS = """
SELECT count(*) FILTER (WHERE item_id IS NULL OR item_id = '') AS missing_item_id,
       count(*) FILTER (WHERE location_id IS NULL OR location_id = '') AS missing_location_id,
       count(*) FILTER (WHERE quantity_on_hand < 0 OR safety_stock < 0 OR in_transit_qty < 0) AS negative_quantities,
       (SELECT count(*) FROM (SELECT 1 FROM {source} GROUP BY item_id, location_id, snapshot_date HAVING count(*) > 1))
         AS duplicate_snapshots,
       count(*) AS total_records, count(DISTINCT item_id) AS unique_items, count(DISTINCT location_id) AS unique_locations
FROM {source}"""


@query("dq_inventory", using="fx_inventory", check=_INVENTORY_CHECKS.format(source="fx_inventory"))
def _(t):
    return dq.inventory_checks(t.inventory_feed())


@query("silver_acceptance", using="dim_supplier fx_shipment clean_inventory", check=f"""
SELECT 'supplier' AS domain, orphaned_records = 0 AND duplicate_current = 0 AS accepted FROM ({_SUPPLIER_CHECKS})
UNION ALL SELECT 'shipment', missing_shipment_id = 0 AND invalid_status = 0
  FROM ({_SHIPMENT_CHECKS.format(source="fx_shipment")})
UNION ALL SELECT 'inventory', missing_item_id = 0 AND negative_quantities = 0
  FROM ({_INVENTORY_CHECKS.format(source="clean_inventory")})""")
def _(t):
    """The uncleaned shipment feed is refused, the cleaned inventory accepted."""
    return (
        dq.accepted(dq.supplier_checks(supplier_dim(t)), "supplier")
        .unionByName(dq.accepted(dq.shipment_checks(t.shipment_feed()), "shipment"))
        .unionByName(dq.accepted(dq.inventory_checks(inv.clean(t.inventory_feed(), AS_OF)), "inventory"))
    )


_GOLD_CHECKS = """
SELECT *, missing_count + invalid_count AS critical_failures,
       CASE WHEN missing_count + invalid_count = 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM (
SELECT 'unified_supply_chain' AS check_name, count(*) AS record_count,
       count(*) FILTER (WHERE product_id IS NULL OR location_id IS NULL OR supplier_id IS NULL) AS missing_count,
       (SELECT count(*) FROM (SELECT 1 FROM unified GROUP BY product_id, location_id, supplier_id, inventory_date,
                              item_id, shipment_id HAVING count(*) > 1)) AS invalid_count FROM unified
UNION ALL
SELECT 'supplier_data', count(*) FILTER (WHERE is_current),
       count(*) FILTER (WHERE is_current AND (name IS NULL OR name = '')),
       (SELECT count(*) FROM (SELECT 1 FROM dim_supplier WHERE is_current GROUP BY business_key HAVING count(*) > 1))
FROM dim_supplier
UNION ALL
SELECT 'inventory_data', count(*), count(*) FILTER (WHERE item_id IS NULL OR location_id IS NULL OR snapshot_date IS NULL),
       count(*) FILTER (WHERE quantity_on_hand < 0 OR safety_stock < 0 OR in_transit_qty < 0) FROM fx_inventory
UNION ALL
SELECT 'shipment_data', count(*), count(*) FILTER (WHERE shipment_id IS NULL OR carrier_id IS NULL OR status IS NULL),
       count(*) FILTER (WHERE status NOT IN ('planned', 'in_transit', 'delivered', 'cancelled')) FROM silver_shipment)"""
_GOLD_TABLES = "unified dim_supplier fx_inventory silver_shipment"


def _gold_checks(t) -> DataFrame:
    return dq.gold_checks(unified_whole(t), supplier_dim(t), t.inventory_feed(), silver_shipments(t))


@query("gold_checks", using=_GOLD_TABLES, check=_GOLD_CHECKS)
def _(t):
    return _gold_checks(t)


@query("gold_overall_status", using=_GOLD_TABLES, check=f"""
SELECT count(*) FILTER (WHERE critical_failures > 0) AS failed_checks, count(*) AS total_checks,
       CASE WHEN count(*) FILTER (WHERE critical_failures > 0) = 0 THEN 'PASS' ELSE 'FAIL' END AS overall_status
FROM ({_GOLD_CHECKS})""")
def _(t):
    return dq.overall_status(_gold_checks(t))


@query("dq_unified_literal", using="unified", check="""
SELECT *, missing_count + invalid_count AS critical_failures,
       CASE WHEN missing_count + invalid_count = 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM (
SELECT 'unified_supply_chain' AS check_name, count(*) AS record_count,
       count(*) FILTER (WHERE product_id IS NULL OR location_id IS NULL OR supplier_id IS NULL) AS missing_count,
       (SELECT count(*) FROM (SELECT 1 FROM unified GROUP BY product_id, location_id, supplier_id, inventory_date
                              HAVING count(*) > 1)) AS invalid_count FROM unified)""")
def _(t):
    return dq.gold_unified_check(unified_whole(t), literal_key=True)


_ROW_RULES = """
SELECT item_id, location_id, snapshot_date, check_id, severity, message FROM (
SELECT *, 'NEG001' AS check_id, 'critical' AS severity, 'Value must be non-negative' AS message FROM fx_inventory
WHERE quantity_on_hand < 0
UNION ALL
SELECT *, 'SAFETY001', 'warning', 'Safety stock is unknown' FROM fx_inventory WHERE safety_stock IS NULL)"""


def _row_rules() -> list[dq.RowRule]:
    return [
        dq.non_negative("quantity_on_hand", "NEG001"),
        dq.RowRule("SAFETY001", "warning", "Safety stock is unknown", F.col("safety_stock").isNull()),
    ]


@query("dq_row_rules", using="fx_inventory", check=_ROW_RULES)
def _(t):
    return dq.run_rules(t.inventory_feed(), _row_rules(), inv.SNAPSHOT)


@query("dq_row_gate", using="fx_inventory", check=f"""
SELECT count(*) FILTER (WHERE severity = 'critical') = 0 AS can_publish, count(*) AS failures FROM ({_ROW_RULES})""")
def _(t):
    return dq.may_publish(dq.run_rules(t.inventory_feed(), _row_rules(), inv.SNAPSHOT))


@query("dq_rates", using="unified fx_inventory dim_supplier", check=f"""
SELECT 'completeness_rate' AS rate,
       round(avg((product_id IS NOT NULL AND location_id IS NOT NULL)::INT), 6) AS value FROM unified
UNION ALL SELECT 'orphan_rate', round(avg((supplier_id IS NULL)::INT), 6) FROM unified
UNION ALL SELECT 'uniqueness_rate', round((SELECT count(*) FROM (SELECT DISTINCT item_id, location_id, snapshot_date
                                                            FROM fx_inventory)) / count(*)::DOUBLE, 6) FROM fx_inventory
UNION ALL SELECT 'sla_compliance_rate', round(avg(CASE WHEN age <= breach THEN 1.0::DOUBLE ELSE 0 END), 6) FROM (
  SELECT date_diff('second', max(load_ts), TIMESTAMP '{AS_OF}') // 60 AS age, 8 AS breach FROM fx_inventory
  UNION ALL SELECT date_diff('second', max(load_ts), TIMESTAMP '{AS_OF}') // 60, 1500 FROM dim_supplier
  UNION ALL SELECT date_diff('second', max(o_orderdate), TIMESTAMP '{AS_OF}') // 60, 75
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)""")
def _(t):
    return rounded(dq.rates(unified_whole(t), t.inventory_feed(), _freshness(t)), "value")


# --- publish gate -------------------------------------------------------------------------------------------


def gate_tables(t) -> dict[str, DataFrame]:
    return {"supplier": supplier_dim(t), "shipment": t.shipment_feed(), "inventory_position": t.inventory_feed()}


_CHECK_HEAD = "SELECT check_id, check_name, severity, 'silver' AS dataset, table_name, column_name, bad = 0 AS passed, " \
              "total AS total_rows, bad AS failing_rows, column_name || ': ' || bad || ' of ' || total || ' ' || wrong AS message FROM ("
_FRESH = """
SELECT 'FRESH001' AS check_id, 'Data freshness' AS check_name, 'warning' AS severity, '{table}' AS table_name,
       'load_ts' AS column_name, 1 AS total, bad, 'overdue' AS wrong
FROM (SELECT CASE WHEN date_diff('second', max(load_ts), TIMESTAMP '""" + AS_OF + """') // 60 <= {warning} THEN 0 ELSE 1 END
        AS bad FROM {source})"""


def _complete(check_id: str, table: str, column: str, source: str) -> str:
    return f"""
SELECT '{check_id}' AS check_id, 'Non-null key completeness' AS check_name, 'critical' AS severity, '{table}' AS table_name,
       '{column}' AS column_name, count(*) AS total, count(*) FILTER (WHERE {column} IS NULL) AS bad, 'without a value' AS wrong
FROM {source}
UNION ALL"""


_GATE_SHIPMENT = _CHECK_HEAD + _complete("COMPL002", "shipment", "shipment_id", "fx_shipment") + """
SELECT 'UNIQ002', 'Shipment ID uniqueness', 'critical', 'shipment', 'shipment_id', count(*),
       count(*) - count(DISTINCT shipment_id), 'repeated' FROM fx_shipment
UNION ALL
SELECT 'REF001', 'Supplier reference integrity', 'critical', 'shipment', 'carrier_id', count(*), bad,
       'without a counterpart in supplier.business_key'
FROM fx_shipment, (SELECT count(*) AS bad FROM fx_shipment
                   WHERE carrier_id NOT IN (SELECT business_key FROM dim_supplier)) WHERE carrier_id IS NOT NULL GROUP BY bad
UNION ALL
SELECT 'RANGE002', 'Valid timestamp ordering', 'warning', 'shipment', 'planned_departure_ts', count(*),
       count(*) FILTER (WHERE planned_departure_ts > actual_departure_ts), 'later than actual_departure_ts'
FROM fx_shipment WHERE planned_departure_ts IS NOT NULL
UNION ALL""" + _FRESH.format(table="shipment", domain="logistics", warning=45, source="fx_shipment") + ")"
_GATE_INVENTORY = _CHECK_HEAD + _complete("COMPL003", "inventory_position", "item_id", "fx_inventory") + """
SELECT 'RANGE001', 'Positive quantity values', 'warning', 'inventory_position', 'quantity_on_hand', count(*),
       count(*) FILTER (WHERE quantity_on_hand < 0), 'below zero'
FROM fx_inventory WHERE quantity_on_hand IS NOT NULL
UNION ALL""" + _FRESH.format(table="inventory_position", domain="inventory", warning=3, source="fx_inventory") + ")"
_GATE_SUPPLIER = _CHECK_HEAD + _complete("COMPL001", "supplier", "business_key", "dim_supplier") + """
SELECT 'UNIQ001', 'Business key uniqueness', 'critical', 'supplier', 'business_key', count(*),
       count(*) - count(DISTINCT business_key), 'repeated'
FROM dim_supplier WHERE is_current
UNION ALL""" + _FRESH.format(table="supplier", domain="supplier", warning=1200, source="dim_supplier") + ")"


@query("gate_checks_shipment", using="fx_shipment dim_supplier", check=_GATE_SHIPMENT)
def _(t):
    return gate.run_checks(t.spark, "silver", "shipment", gate_tables(t), AS_OF)


@query("gate_checks_inventory", using="fx_inventory", check=_GATE_INVENTORY)
def _(t):
    return gate.run_checks(t.spark, "silver", "inventory_position", gate_tables(t), AS_OF)


@query("gate_checks_supplier", using="dim_supplier", check=_GATE_SUPPLIER)
def _(t):
    return gate.run_checks(t.spark, "silver", "supplier", gate_tables(t), AS_OF)


def _gate_sql(table: str, checks: str) -> str:
    stamp = AS_OF.replace("-", "").replace(":", "").replace(" ", "_")
    return f"""
SELECT 'silver_{table}_{stamp}' AS evaluation_id, 'silver' AS dataset, '{table}' AS table_name,
       CASE WHEN c > 0 THEN 'blocked' ELSE 'open' END AS status, c = 0 AS can_publish,
       CAST(n AS INT) AS total_checks, CAST(n - f AS INT) AS passed_checks, CAST(f AS INT) AS failed_checks,
       CAST(c AS INT) AS critical_failures, CAST(w AS INT) AS warning_failures, CAST(0 AS INT) AS info_failures,
       TIMESTAMP '{AS_OF}' AS evaluation_time,
       CASE WHEN c > 0 THEN 'closed: critical checks failed: ' || c
            WHEN w > 0 THEN 'open, to be looked at: warnings ' || w || ', infos 0'
            ELSE 'open' END AS message, TIMESTAMP '{AS_OF}' AS created_ts
FROM (SELECT count(*) AS n, count(*) FILTER (WHERE NOT passed) AS f,
             count(*) FILTER (WHERE NOT passed AND severity = 'critical') AS c,
             count(*) FILTER (WHERE NOT passed AND severity = 'warning') AS w FROM ({checks}))"""


@query("gate_result", using="fx_shipment dim_supplier fx_inventory", check=" UNION ALL ".join(
    f"SELECT * FROM ({_gate_sql(table, sql)})" for table, sql in
    (("shipment", _GATE_SHIPMENT), ("inventory_position", _GATE_INVENTORY), ("supplier", _GATE_SUPPLIER))))
def _(t):
    """Gate-log rows of all three tables: shipments are blocked, inventory and suppliers open with warnings."""
    tables = gate_tables(t)
    return reduce(DataFrame.unionByName, [
        gate.evaluate(gate.run_checks(t.spark, "silver", name, tables, AS_OF), "silver", name, AS_OF)
        for name in ("shipment", "inventory_position", "supplier")
    ])


@query("gate_dq_response", using="fx_shipment dim_supplier fx_inventory", check=f"""
SELECT dataset || '.' || table_name AS dataset,
       count(*) FILTER (WHERE NOT passed AND severity = 'critical') = 0 AS critical_checks_passed,
       coalesce(string_agg(check_id, ',' ORDER BY check_id) FILTER (WHERE NOT passed), '') AS failed_checks
FROM (SELECT * FROM ({_GATE_SHIPMENT}) UNION ALL SELECT * FROM ({_GATE_INVENTORY})
      UNION ALL SELECT * FROM ({_GATE_SUPPLIER})) GROUP BY 1""")
def _(t):
    tables = gate_tables(t)
    results = reduce(DataFrame.unionByName, [gate.run_checks(t.spark, "silver", name, tables, AS_OF) for name in tables])
    return gate.dq_response(results).select(
        "dataset", F.col("criticalChecksPassed").alias("critical_checks_passed"),
        F.array_join(F.col("failedChecks.checkId"), ",").alias("failed_checks"),
    )


@query("dq_table_status", using="fx_shipment dim_supplier", check=f"""
SELECT 'silver.shipment' AS table_name, TIMESTAMP '{AS_OF}' AS check_timestamp,
       count(*) FILTER (WHERE NOT passed AND severity = 'critical') = 0 AS critical_checks_passed,
       CAST(count(*) FILTER (WHERE NOT passed) AS INT) AS failed_checks_count,
       (SELECT quality_score FROM ({_score_sql("fx_shipment", SHIPMENT_COLUMNS, _SHIPMENT_RULES)})) AS quality_score,
       coalesce(string_agg(check_id, ',' ORDER BY check_id) FILTER (WHERE NOT passed), '') AS details,
       TIMESTAMP '{AS_OF}' AS created_ts
FROM ({_GATE_SHIPMENT})""")
def _(t):
    results = gate.run_checks(t.spark, "silver", "shipment", gate_tables(t), AS_OF)
    row = gate.table_status(results, dq.quality_score(t.shipment_feed(), "shipment"), "silver.shipment", AS_OF)
    return rounded(row, "quality_score")


@query("gate_alerts", using="fx_shipment dim_supplier", check=f"""
SELECT 'data_quality' AS alert_type, 'silver.shipment' AS subject, severity, message, TIMESTAMP '{AS_OF}' AS detected_ts,
       TIMESTAMP '{AS_OF}' + INTERVAL 10 MINUTE AS due_ts FROM ({_GATE_SHIPMENT})
WHERE NOT passed AND severity = 'critical'""")
def _(t):
    return gate.alert_rows(gate.run_checks(t.spark, "silver", "shipment", gate_tables(t), AS_OF), AS_OF)


@query("referential_orphans", using="fx_shipment", check="""
SELECT carrier_id AS value, count(*) AS rows FROM fx_shipment
WHERE carrier_id NOT IN (SELECT 'SUP_' || lpad(CAST(s_suppkey AS VARCHAR), 6, '0') FROM supplier WHERE s_acctbal >= 0)
GROUP BY carrier_id""")
def _(t):
    """Shipments whose carrier is not among the suppliers in good standing."""
    known = t.raw("supplier").filter("s_acctbal >= 0").selectExpr("concat('SUP_', lpad(s_suppkey, 6, '0')) AS key")
    return gate.orphans(t.shipment_feed(), "carrier_id", known, "key")


# --- freshness ----------------------------------------------------------------------------------------------

_FRESHNESS = f"""
SELECT domain, last_updated, target AS target_sla_minutes, warning AS warning_threshold_minutes,
       breach AS breach_threshold_minutes,
       CASE WHEN age <= warning THEN 'ok' WHEN age <= breach THEN 'warning' ELSE 'breach' END AS status,
       CAST(age AS INT) AS age_minutes, TIMESTAMP '{AS_OF}' AS created_ts, TIMESTAMP '{AS_OF}' AS updated_ts
FROM (SELECT *, date_diff('second', last_updated, TIMESTAMP '{AS_OF}') // 60 AS age FROM (
  SELECT 'supplier' AS domain, max(load_ts) AS last_updated, 1440 AS target, 1200 AS warning, 1500 AS breach FROM dim_supplier
  UNION ALL SELECT 'logistics', max(load_ts), 60, 45, 75 FROM fx_shipment
  UNION ALL SELECT 'inventory', max(load_ts), 5, 3, 8 FROM fx_inventory))"""
_FRESH_TABLES = "dim_supplier fx_shipment fx_inventory"


def _freshness(t) -> DataFrame:
    return freshness.refresh(
        {"supplier": supplier_dim(t), "logistics": t.shipment_feed(), "inventory": t.inventory_feed()}, AS_OF)


@query("freshness_status", using=_FRESH_TABLES, check=_FRESHNESS)
def _(t):
    return _freshness(t)


@query("freshness_summary", using=_FRESH_TABLES, check=f"""
SELECT count(*) AS total_domains, count(*) FILTER (WHERE status = 'ok') AS ok_domains,
       count(*) FILTER (WHERE status = 'warning') AS warning_domains,
       count(*) FILTER (WHERE status = 'breach') AS breach_domains, count(*) FILTER (WHERE status = 'missing') AS missing_domains,
       {", ".join(f"max({c}) FILTER (WHERE domain = '{d}') AS {d}_{c}" for d in freshness.SLAS for c in freshness.DETAIL)}
FROM ({_FRESHNESS})""")
def _(t):
    return freshness.summary(_freshness(t))


@query("freshness_alerts", using=_FRESH_TABLES, check=f"""
SELECT 'freshness' AS alert_type, domain AS subject, 'critical' AS severity,
       'data is ' || age_minutes || ' minutes old, limit ' || breach_threshold_minutes AS message,
       TIMESTAMP '{AS_OF}' AS detected_ts, TIMESTAMP '{AS_OF}' + INTERVAL 10 MINUTE AS due_ts
FROM ({_FRESHNESS}) WHERE status = 'breach'""")
def _(t):
    return freshness.breach_rows(_freshness(t), AS_OF)


@query("freshness_warnings", using=_FRESH_TABLES, check=f"SELECT * FROM ({_FRESHNESS}) WHERE status = 'warning'")
def _(t):
    return freshness.alerts(_freshness(t), "warning")


@query("freshness_current", using=_FRESH_TABLES, check=f"SELECT * FROM ({_FRESHNESS})")
def _(t):
    """Two evaluations in the status history; the later one is current."""
    earlier = freshness.refresh(
        {"supplier": supplier_dim(t), "logistics": t.shipment_feed(), "inventory": t.inventory_feed()}, "2001-11-01 00:00:00")
    return freshness.current(earlier.unionByName(_freshness(t)))


@query("freshness_response", using=_FRESH_TABLES, check=f"""
SELECT max(status) FILTER (WHERE domain = 'supplier') AS supplier,
       max(status) FILTER (WHERE domain = 'logistics') AS logistics,
       max(target_sla_minutes) FILTER (WHERE domain = 'inventory') AS inventory_target FROM ({_FRESHNESS})""")
def _(t):
    return freshness.response(_freshness(t)).select(
        F.col("supplier.status").alias("supplier"), F.col("logistics.status").alias("logistics"),
        F.col("inventory.targetSlaMinutes").alias("inventory_target"))


# --- contracts ----------------------------------------------------------------------------------------------

_CONTRACT_ERRORS = """
SELECT shipment_id, planned_arrival, field_path, error_type, 'error' AS severity,
       CASE error_type WHEN 'missing_required_field' THEN 'no value for ' || field_path
            WHEN 'max_length_violation' THEN length(actual_value) || ' characters where 50 are the most'
            WHEN 'type_mismatch' THEN 'no ' || CASE field_path WHEN 'weight' THEN 'double' ELSE 'timestamp' END
            WHEN 'invalid_value' THEN actual_value || ' is none of planned, in_transit, delivered, cancelled'
            ELSE actual_value || ' is below 0.0' END AS message,
       CASE WHEN error_type = 'type_mismatch' THEN CASE field_path WHEN 'weight' THEN 'double' ELSE 'timestamp' END END AS expected_type,
       actual_value FROM (
SELECT *, 'carrier_id' AS field_path, 'missing_required_field' AS error_type, NULL AS actual_value FROM fx_shipment_text
WHERE carrier_id IS NULL
UNION ALL SELECT *, 'destination', 'missing_required_field', NULL FROM fx_shipment_text WHERE destination IS NULL
UNION ALL SELECT *, 'shipment_id', 'max_length_violation', shipment_id FROM fx_shipment_text WHERE length(shipment_id) > 50
UNION ALL SELECT *, 'planned_departure', 'type_mismatch', planned_departure FROM fx_shipment_text
WHERE planned_departure IS NOT NULL AND TRY_CAST(planned_departure AS TIMESTAMP) IS NULL
UNION ALL SELECT *, 'status', 'invalid_value', status FROM fx_shipment_text
WHERE status NOT IN ('planned', 'in_transit', 'delivered', 'cancelled')
UNION ALL SELECT *, 'weight', 'type_mismatch', weight FROM fx_shipment_text
WHERE weight IS NOT NULL AND TRY_CAST(weight AS DOUBLE) IS NULL
UNION ALL SELECT *, 'weight', 'min_value_violation', weight FROM fx_shipment_text WHERE TRY_CAST(weight AS DOUBLE) < 0
UNION ALL SELECT *, 'volume', 'min_value_violation', volume FROM fx_shipment_text WHERE TRY_CAST(volume AS DOUBLE) < 0)"""
SHIPMENT_CONTRACT = contracts.CONTRACTS["shipment_raw"]


@query("contract_errors", using="fx_shipment_text", check=_CONTRACT_ERRORS)
def _(t):
    return contracts.errors(t.shipment_text(), SHIPMENT_CONTRACT, ["shipment_id", "planned_arrival"])


@query("contract_errors_supplier", using="fx_supplier_feed", check="""
SELECT natural_key, load_ts, 'region' AS field_path, 'missing_required_field' AS error_type, 'error' AS severity,
       'no value for region' AS message, CAST(NULL AS VARCHAR) AS expected_type,
       CAST(NULL AS VARCHAR) AS actual_value FROM fx_supplier_feed WHERE region IS NULL""")
def _(t):
    raw = t.supplier_feed().withColumns({"supplier_id": F.col("natural_key"), "supplier_name": F.col("name")})
    return contracts.errors(raw, contracts.CONTRACTS["supplier_raw"], ["natural_key", "load_ts"])


@query("contract_errors_inventory", using="fx_inventory", check="""
SELECT item_id, location_id, snapshot_date, field_path, error_type, 'error' AS severity,
       CASE error_type WHEN 'type_mismatch' THEN 'no double' ELSE actual_value || ' is below 0.0' END
         AS message,
       CASE error_type WHEN 'type_mismatch' THEN 'double' END AS expected_type, actual_value FROM (
SELECT *, 'quantity_on_hand' AS field_path, 'min_value_violation' AS error_type, CAST(quantity_on_hand AS VARCHAR) AS actual_value
FROM fx_inventory WHERE quantity_on_hand < 0
UNION ALL SELECT *, 'safety_stock', 'min_value_violation', CAST(safety_stock AS VARCHAR) FROM fx_inventory WHERE safety_stock < 0
UNION ALL SELECT *, 'in_transit_qty', 'type_mismatch', CAST(in_transit_qty > 0 AS VARCHAR) FROM fx_inventory
WHERE in_transit_qty IS NOT NULL)""")
def _(t):
    """Typed columns are judged, too: quantities in transit come as true or false here, which no number is."""
    feed = t.inventory_feed().withColumn("in_transit_qty", F.col("in_transit_qty") > 0)
    return contracts.errors(feed, contracts.CONTRACTS["inventory_raw"], ["item_id", "location_id", "snapshot_date"])


@query("contract_counts", using="fx_shipment_text", check=f"""
SELECT field_path, error_type, count(*) AS error_count FROM ({_CONTRACT_ERRORS}) GROUP BY 1, 2""")
def _(t):
    return contracts.error_counts(t.shipment_text(), SHIPMENT_CONTRACT)


_BAD_ROW = """(carrier_id IS NULL OR destination IS NULL OR length(shipment_id) > 50
  OR (planned_departure IS NOT NULL AND TRY_CAST(planned_departure AS TIMESTAMP) IS NULL)
  OR status NOT IN ('planned', 'in_transit', 'delivered', 'cancelled')
  OR (weight IS NOT NULL AND TRY_CAST(weight AS DOUBLE) IS NULL) OR coalesce(TRY_CAST(weight AS DOUBLE) < 0, false))"""


@query("contract_summary", using="fx_shipment_text", check=f"""
SELECT 'shipment_raw' AS schema_name, count(*) AS total_records, count(*) FILTER (WHERE NOT {_BAD_ROW}) AS valid_records,
       count(*) FILTER (WHERE {_BAD_ROW}) AS invalid_records, (SELECT count(*) FROM ({_CONTRACT_ERRORS})) AS error_count,
       CAST(0 AS BIGINT) AS warning_count, false AS is_valid FROM fx_shipment_text""")
def _(t):
    return contracts.summary(t.shipment_text(), SHIPMENT_CONTRACT)


@query("quarantine_rows", using="fx_shipment_text", check=f"SELECT * FROM fx_shipment_text WHERE {_BAD_ROW}")
def _(t):
    return contracts.split(t.shipment_text(), SHIPMENT_CONTRACT)[1].drop("_errors")


@query("contract_valid_rows", using="fx_shipment_text", check=f"SELECT * FROM fx_shipment_text WHERE NOT {_BAD_ROW}")
def _(t):
    return contracts.split(t.shipment_text(), SHIPMENT_CONTRACT)[0]


@query("contract_log", using="fx_shipment_text", check=f"""
SELECT 'shipment_raw' AS schema_name, 'wms_system' AS source_system, false AS is_valid, count(*) AS total_records,
       count(*) FILTER (WHERE {_BAD_ROW}) AS invalid_records, (SELECT count(*) FROM ({_CONTRACT_ERRORS})) AS error_count,
       TIMESTAMP '{AS_OF}' AS validation_time FROM fx_shipment_text""")
def _(t):
    return contracts.log_row(t.shipment_text(), SHIPMENT_CONTRACT, "wms_system", AS_OF).select(
        "schema_name", "source_system", "is_valid", "total_records", "invalid_records", "error_count", "validation_time")


@query("contract_log_full", using="fx_shipment_text", check=f"""
SELECT 'shipment_raw_wms_system_{AS_OF.replace('-', '').replace(':', '').replace(' ', '_')}' AS validation_id, 'shipment_raw' AS schema_name,
       'wms_system' AS source_system, false AS is_valid, count(*) AS total_records, count(*) FILTER (WHERE NOT ({_BAD_ROW})) AS valid_records,
       count(*) FILTER (WHERE {_BAD_ROW}) AS invalid_records, (SELECT count(*) FROM ({_CONTRACT_ERRORS})) AS error_count, CAST(0 AS BIGINT) AS warning_count,
       TIMESTAMP '{AS_OF}' AS validation_time, TIMESTAMP '{AS_OF}' AS created_ts,
       (SELECT string_agg(field_path || ' ' || error_type || ' ' || n, '; ' ORDER BY field_path, error_type) FROM (
          SELECT field_path, error_type, count(*) AS n FROM ({_CONTRACT_ERRORS}) GROUP BY field_path, error_type)) AS kinds
FROM fx_shipment_text""")
def _(t):
    """Every column of the validation log; the errors of ``errors_json`` as text in a fixed order."""
    log = contracts.log_row(t.shipment_text(), SHIPMENT_CONTRACT, "wms_system", AS_OF)
    kinds = F.sort_array(F.from_json("errors_json", "array<struct<field_path string, error_type string, error_count bigint>>"))
    shown = F.transform(kinds, lambda k: F.concat_ws(" ", k["field_path"], k["error_type"], k["error_count"].cast("string")))
    return log.withColumn("kinds", F.concat_ws("; ", shown)).drop("errors_json")


@query("contract_custom", using="fx_inventory", check="""
SELECT field_path, error_type, error_count FROM (
  SELECT 'location_id' AS field_path, 'invalid_value' AS error_type, count(*) FILTER (WHERE location_id NOT IN ('WH001', 'WH002')) AS error_count
  FROM fx_inventory
  UNION ALL SELECT 'in_transit_qty', 'max_value_violation', count(*) FILTER (WHERE in_transit_qty > 4) FROM fx_inventory
  UNION ALL SELECT 'safety_stock', 'missing_required_field', count(*) FILTER (WHERE safety_stock IS NULL) FROM fx_inventory)
WHERE error_count > 0""")
def _(t):
    """A contract of one's own."""
    own = contracts.Contract("own", "wms_system", ("item_id", "safety_stock"), {"location_id": "string", "in_transit_qty": "double"},
                             {"location_id": {"allowed_values": ["WH001", "WH002"]}, "in_transit_qty": {"max_value": 4.0}})
    return contracts.error_counts(t.inventory_feed(), own)


@query("gate_custom_checks", using="fx_inventory", check=_CHECK_HEAD.replace("'silver' AS dataset", "dataset") + """
SELECT 'OWN001' AS check_id, 'In transit below four' AS check_name, 'info' AS severity, '*' AS dataset, 'inventory_position' AS table_name,
       'in_transit_qty' AS column_name, count(*) AS total, count(*) FILTER (WHERE in_transit_qty >= 4) AS bad, 'against OWN001' AS wrong FROM fx_inventory
UNION ALL
SELECT 'OWN002', 'Locations known', 'critical', 'silver', 'inventory_position', 'location_id', count(*),
       count(*) FILTER (WHERE location_id IS NULL), 'without a value' FROM fx_inventory)""")
def _(t):
    """Checks of one's own on top of the table's, by themselves."""
    own = [gate.Check("OWN001", "In transit below four", "info", "*", "*", "in_transit_qty", "predicate", violated=F.col("in_transit_qty") >= 4),
           gate.Check("OWN002", "Locations known", "critical", "silver", "inventory_position", "location_id", "completeness")]
    chosen = [c for c in gate.checks_for("silver", "inventory_position", gate.with_checks(*own)) if c.check_id.startswith("OWN")]
    return gate.run_checks(t.spark, "silver", "inventory_position", {"inventory_position": t.inventory_feed()}, AS_OF, chosen)


@query("freshness_custom", using=_FRESH_TABLES, check=f"""
SELECT domain, last_updated, 100 AS target_sla_minutes, 10 AS warning_threshold_minutes, 100000000 AS breach_threshold_minutes,
       CASE WHEN age <= 10 THEN 'ok' WHEN age <= 100000000 THEN 'warning' ELSE 'breach' END AS status, CAST(age AS INT) AS age_minutes
FROM (SELECT *, date_diff('second', last_updated, TIMESTAMP '{AS_OF}') // 60 AS age FROM (
  SELECT 'inventory' AS domain, max(load_ts) AS last_updated FROM fx_inventory))""")
def _(t):
    """Service levels of one's own; a domain without one isn't judged."""
    slas = {"inventory": freshness.Sla(100, 10, 100_000_000)}
    tables = {"supplier": supplier_dim(t), "inventory": t.inventory_feed()}
    return freshness.refresh(tables, AS_OF, slas).drop("created_ts", "updated_ts")


# --- late data ----------------------------------------------------------------------------------------------

LATE_AS_OF = "2001-08-01 00:00:00"


@query("late_touched_keys", using="fx_shipment", check="""
SELECT DISTINCT shipment_id FROM fx_shipment
WHERE load_ts >= TIMESTAMP '2001-08-01' - INTERVAL 720 HOUR AND load_ts <= TIMESTAMP '2001-08-01'""")
def _(t):
    return late.touched_keys(t.shipment_feed(), ["shipment_id"], LATE_AS_OF, 720, "load_ts")


@query("late_merge", using="silver_shipment", check="SELECT * FROM silver_shipment")
def _(t):
    """Silver as of 30 days ago, then the late rows: equal to processing everything at once."""
    feed = shp.clean(t.shipment_feed(), AS_OF)
    before = F.col("load_ts") < ts(LATE_AS_OF) - F.make_dt_interval(days=F.lit(30))
    silver = t.stored(shp.latest_version(feed.filter(before)), "silver-shipment")
    return late.merge_late(silver, feed, ["shipment_id"], [F.col("load_ts").desc_nulls_last()], LATE_AS_OF, 720)


# --- governance ---------------------------------------------------------------------------------------------


@query("retention_keep", using="silver_inventory", check=f"""
SELECT * FROM silver_inventory WHERE load_ts IS NULL OR load_ts >= TIMESTAMP '{AS_OF}' - INTERVAL 365 DAY""")
def _(t):
    return gov.within_retention(silver_inventory(t), "silver", AS_OF)


@query("retention_expired", using="fx_shipment", check=f"""
SELECT source_system, count(*) AS expired_rows FROM fx_shipment
WHERE load_ts < TIMESTAMP '{AS_OF}' - INTERVAL 90 DAY GROUP BY 1""")
def _(t):
    return gov.expired(t.shipment_feed(), "bronze", AS_OF).groupBy("source_system").agg(
        F.count("*").alias("expired_rows"))


@query("masked_export", using="dim_supplier", check="""
SELECT natural_key, business_key, sha256(name) AS name, status, region, effective_start_ts, effective_end_ts, is_current,
       source_system, load_ts FROM dim_supplier WHERE region = 'EUROPE'""")
def _(t):
    return gov.masked_for(supplier_dim(t), "external_partner", region="EUROPE")


@query("masked_auditor", using="dim_supplier", check="""
SELECT natural_key, business_key, sha256(name) AS name, status, region, effective_start_ts, effective_end_ts, is_current,
       source_system, load_ts FROM dim_supplier""")
def _(t):
    return gov.masked_for(supplier_dim(t), "auditor")


@query("lineage_rows", using="silver_shipment", check=f"""
SELECT 'run-1' AS run_id, 'silver.shipment' AS target, s.source_table, n AS rows_written, TIMESTAMP '{AS_OF}' AS recorded_ts
FROM (SELECT count(*) AS n FROM silver_shipment),
     (SELECT 'bronze.shipment_raw' AS source_table UNION ALL SELECT 'silver.crosswalk') s""")
def _(t):
    return gov.lineage_from_counts(silver_shipments(t), "run-1", "silver.shipment",
                                   ["bronze.shipment_raw", "silver.crosswalk"], AS_OF)


@query("load_metrics", using="fx_shipment", check="""
SELECT source_system, CAST(load_ts AS DATE) AS load_date, count(*) AS rows_loaded, min(load_ts) AS first_load_ts,
       max(load_ts) AS last_load_ts, date_diff('second', min(load_ts), max(load_ts)) AS span_seconds
FROM fx_shipment GROUP BY 1, 2""")
def _(t):
    return gov.load_metrics(t.shipment_feed())


@query("data_dictionary", using="silver_shipment", check="""
SELECT 'silver.shipment' AS table_name, * FROM (""" + " UNION ALL ".join(
    f"SELECT {i} AS position, '{c}' AS column_name, '{'timestamp_ntz' if c.endswith('_ts') else 'string'}' AS data_type, "
    f"count(*) AS row_count, count(*) FILTER (WHERE {c} IS NULL) AS null_count FROM silver_shipment"
    for i, c in enumerate(SHIPMENT_COLUMNS)) + ")")
def _(t):
    return gov.column_profile(silver_shipments(t).select(*SHIPMENT_COLUMNS), "silver.shipment")


@query("clustered_layout", using="silver_inventory", check="SELECT * FROM silver_inventory")
def _(t):
    """Rewrite clustered by location and date, read back."""
    return t.stored(gov.clustered(silver_inventory(t), ["location_id", "snapshot_date"]), "clustered")


@query("schema_evolution", using="fx_inventory", check="""
SELECT item_id, location_id, snapshot_date, quantity_on_hand, safety_stock, in_transit_qty, load_ts, source_system,
       CAST(NULL AS TIMESTAMP) AS created_at, quantity_on_hand * 2 AS doubled_qty FROM fx_inventory""")
def _(t):
    from stocktide import schemas

    fitted, _added = gov.evolve(
        t.inventory_feed().withColumn("doubled_qty", F.col("quantity_on_hand") * 2),
        schemas.TABLES["silver.inventory_position"])
    return fitted
