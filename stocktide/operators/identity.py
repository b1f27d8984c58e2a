"""Identity resolution: crosswalk first, then trust order, then survivorship."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stocktide.functions.timeexpr import ts
from stocktide.operators import crosswalk as xw
from stocktide.operators.common import first_per_key


@dataclass(frozen=True)
class Rule:
    trusted: tuple[str, ...]  # most trusted first
    survivor_field: str
    descending: bool = True


# Trust order and survivorship field per entity type.
RULES: dict[str, Rule] = {
    "supplier": Rule(("erp_system", "manual_entry", "wms_system"), "effective_start_ts"),
    "product": Rule(("erp_system", "manual_entry", "wms_system"), "created_ts"),
    "location": Rule(("wms_system", "erp_system", "manual_entry"), "created_ts"),
    "shipment": Rule(("wms_system", "erp_system"), "load_ts"),
}

# Trust level per source system, reported only.
TRUST_LEVELS = {
    "erp_system": "high",
    "wms_system": "medium",
    "external_api": "low",
    "manual_entry": "high",
    "legacy_system": "low",
}


def rules_for(entity_types: Iterable[str], rules: Mapping[str, Rule] = RULES) -> dict[str, Rule]:
    wanted = set(entity_types)
    return {name: rule for name, rule in rules.items() if name in wanted}


def trust_rank(source_system: Column, rule: Rule) -> Column:
    """Position in the trust order; systems outside it rank after all of them."""
    position = F.array_position(F.array(*[F.lit(s) for s in rule.trusted]), source_system)
    outside = F.lit(len(rule.trusted))
    return F.when(position > 0, position.cast("int") - 1).otherwise(outside)


def resolve(
    records: DataFrame,
    crosswalk: DataFrame,
    entity_type: str,
    group_col: str = "source_key",
    rules: Mapping[str, Rule] = RULES,
) -> DataFrame:
    """One surviving record per group, with its business key.

    Records that the crosswalk knows win over unknown ones; among several
    business keys the one with the most trusted source wins (ties: smallest
    key). Inside the winning key the survivorship field decides. A group
    without any known record gets a minted key (``is_new_key``).
    """
    if entity_type not in rules:
        raise ValueError(f"no resolution rule for entity type {entity_type}")
    rule = rules[entity_type]
    group = [group_col, "entity_type"]
    known = xw.resolve_keys(records.filter(F.col("entity_type") == entity_type), crosswalk)
    ranked = known.withColumns({
        "_key": F.coalesce("business_key", F.lit("")),
        "_rank": trust_rank(F.col("source_system"), rule),
    })
    field = F.col(rule.survivor_field)
    order = [field.desc_nulls_last() if rule.descending else field.asc_nulls_last(),
             F.col("_rank").asc(), F.col("source_system").asc(), F.col("source_key").asc()]
    survivors = first_per_key(ranked, [*group, "_key"], order).drop("_rank")
    trust = ranked.groupBy(*group, "_key").agg(F.min("_rank").alias("trust_score"))
    candidates = survivors.join(trust, [*group, "_key"])
    winner = first_per_key(
        candidates, group,
        [F.col("business_key").isNull().asc(), F.col("trust_score").asc(), F.col("_key").asc()],
    )
    return winner.withColumns({
        "is_new_key": F.col("business_key").isNull(),
        "business_key": F.coalesce("business_key", minted_key()),
    }).drop("_key")


def minted_key() -> Column:
    """Business key of a source key that nothing maps: a function of the key, so two writers mint the same one."""
    return F.concat_ws("_", F.upper("entity_type"), "source_system", "source_key")


def mint(keys: DataFrame) -> DataFrame:
    """Crosswalk rows with a new business key for (source_system, source_key, entity_type)."""
    return keys.select(*xw.KEY, minted_key().alias("business_key"), F.lit(1.0).alias("confidence"))


def new_mappings(resolved: DataFrame) -> DataFrame:
    """Crosswalk rows for the minted keys."""
    return resolved.filter("is_new_key").select(*xw.KEY, "business_key", F.lit(1.0).alias("confidence"))


def resolve_and_extend(
    records: DataFrame, crosswalk: DataFrame, entity_type: str, as_of: str, group_col: str = "source_key"
) -> tuple[DataFrame, DataFrame]:
    """Resolved records with ``resolved_ts`` and the crosswalk including minted keys."""
    resolved = resolve(records, crosswalk, entity_type, group_col).withColumn("resolved_ts", ts(as_of))
    return resolved, xw.add_mappings(crosswalk, new_mappings(resolved), as_of)


def rules_table(spark: SparkSession, rules: Mapping[str, Rule] = RULES) -> DataFrame:
    """Trust order as rows (entity_type, source_system, trust_rank, survivor_field, survivor_order)."""
    rows = [
        (name, system, rank, rule.survivor_field, "desc" if rule.descending else "asc")
        for name, rule in rules.items()
        for rank, system in enumerate(rule.trusted)
    ]
    return spark.createDataFrame(
        rows, "entity_type string, source_system string, trust_rank int, survivor_field string, survivor_order string"
    )


def statistics(crosswalk: DataFrame, rules: Mapping[str, Rule] = RULES) -> DataFrame:
    """Crosswalk integrity next to the number of rules and trust levels in force."""
    return xw.integrity(crosswalk).select(
        "*",
        F.lit(len(rules)).alias("resolution_rules"),
        F.lit(len(TRUST_LEVELS)).alias("trust_levels"),
    )
