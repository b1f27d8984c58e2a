import datetime as dt

import pytest

from stocktide.operators import crosswalk as xw, identity
from stocktide.sources import generate

RECORDS = ("record_group string, entity_type string, source_system string, source_key string, name string, "
           "effective_start_ts timestamp_ntz")
MAPPINGS = ("source_system string, source_key string, entity_type string, business_key string, confidence double, "
            "created_ts timestamp_ntz, is_active boolean")
DAY = dt.datetime(2024, 1, 1)


def record(group, system, key, day=None, name="n"):
    return (group, "supplier", system, key, name, DAY + dt.timedelta(days=day) if day is not None else None)


def mapping(system, key, business, confidence=1.0, day=0, active=True):
    return (system, key, "supplier", business, confidence, DAY + dt.timedelta(days=day), active)


def resolve(spark, records, mappings):
    out = identity.resolve(spark.createDataFrame(records, RECORDS), spark.createDataFrame(mappings, MAPPINGS),
                           "supplier", "record_group")
    return {r.record_group: r for r in out.collect()}


def test_trusted_source_decides_between_business_keys(spark):
    got = resolve(spark,
                  [record("g", "wms_system", "w", 9), record("g", "erp_system", "e", 1), record("g", "external_api", "x", 99)],
                  [mapping("wms_system", "w", "B_WMS"), mapping("erp_system", "e", "B_ERP"), mapping("external_api", "x", "B_X")])
    assert (got["g"].business_key, got["g"].source_system, got["g"].trust_score) == ("B_ERP", "erp_system", 0)


def test_survivorship_inside_the_winning_key(spark):
    got = resolve(spark,
                  [record("g", "erp_system", "e", 1, "old"), record("g", "wms_system", "w", 5, "new"),
                   record("g", "manual_entry", "m", None, "undated")],
                  [mapping("erp_system", "e", "B"), mapping("wms_system", "w", "B"), mapping("manual_entry", "m", "B")])
    assert got["g"].name == "new"


def test_all_null_survivorship_falls_back_to_trust(spark):
    got = resolve(spark, [record("g", "wms_system", "w"), record("g", "erp_system", "e")],
                  [mapping("erp_system", "e", "B"), mapping("wms_system", "w", "B")])
    assert got["g"].source_system == "erp_system"


def test_trust_tie_takes_smallest_business_key(spark):
    got = resolve(spark, [record("g", "erp_system", "e1", 1), record("g", "erp_system", "e2", 9)],
                  [mapping("erp_system", "e1", "B1"), mapping("erp_system", "e2", "B2")])
    assert got["g"].business_key == "B1"


def test_unmapped_group_gets_a_minted_key(spark):
    got = resolve(spark, [record("g", "external_api", "x", 3), record("g", "legacy_system", "l", 1)],
                  [mapping("erp_system", "e", "B")])
    assert (got["g"].business_key, got["g"].is_new_key) == ("SUPPLIER_external_api_x", True)


def test_best_mapping_and_inactive(spark, rows):
    frame = spark.createDataFrame([
        mapping("s", "k", "LOW", 0.5, 9), mapping("s", "k", "OLD", 0.9, 1), mapping("s", "k", "NEW", 0.9, 2),
        mapping("s", "k", "OFF", 1.0, 9, active=False),
    ], MAPPINGS)
    assert rows(xw.best_mappings(frame), "business_key") == [("NEW",)]
    row = xw.integrity(frame).first()
    assert (row.total_active_mappings, row.duplicate_mappings) == (3, 1)


def test_add_and_deactivate(spark, rows):
    base = generate.default_crosswalk(spark, "2024-01-01")
    assert rows(base, "source_key", "business_key", "confidence", "is_active") == [
        ("SUP001", "SUP_ACME_CORP", 1.0, True), ("SUP002", "SUP_BETA_INC", 1.0, True),
        ("VENDOR_123", "SUP_ACME_CORP", 1.0, True), ("VENDOR_456", "SUP_BETA_INC", 1.0, True)]
    keys = spark.createDataFrame([("erp_system", "SUP001", "supplier")], "source_system string, source_key string, entity_type string")
    off = xw.deactivate(base, keys, "2024-02-01")
    assert rows(off.filter("NOT is_active"), "source_key", "updated_ts") == [("SUP001", dt.datetime(2024, 2, 1))]
    assert rows(xw.deactivate(off, keys, "2024-03-01")) == rows(off)


def test_unknown_entity_type_and_rule_selection(spark):
    with pytest.raises(ValueError):
        identity.resolve(spark.createDataFrame([], RECORDS), spark.createDataFrame([], MAPPINGS), "planet")
    assert set(identity.rules_for(["product", "none"])) == {"product"}
    assert identity.rules_table(spark).count() == 11


def test_resolved_keys_join_the_crosswalk(spark):
    records = spark.createDataFrame([record("g", "external_api", "x", 3)], RECORDS)
    crosswalk = spark.createDataFrame([mapping("erp_system", "e", "B")], MAPPINGS)
    resolved, extended = identity.resolve_and_extend(records, crosswalk, "supplier", "2024-05-05", "record_group")
    again = xw.resolve_keys(records, extended).first()
    assert again.business_key == resolved.first().business_key
