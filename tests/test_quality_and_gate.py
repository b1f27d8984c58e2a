import datetime as dt

import pytest
from pyspark.sql import functions as F

from stocktide.operators import contracts, freshness, gate, governance as gov, quality

from test_cleaning import INVENTORY, SHIPMENT, shipment, stock

CONTRACT = contracts.CONTRACTS


def score(spark, data, table="inventory", schema=INVENTORY):
    return quality.quality_score(spark.createDataFrame(data, schema), table).first()


def test_score_of_empty_table_is_zero(spark):
    row = score(spark, [])
    assert (row.quality_score, row.is_valid) == (0.0, False)


def test_score_caps(spark):
    schema = "a double, b string"
    nulls = score(spark, [(None, str(i)) for i in range(10)], "t", schema)
    assert (nulls.null_penalty, nulls.duplicate_penalty, nulls.constraint_penalty) == (0.3, 0.0, 0.0)
    repeats = score(spark, [(1.0, "x")] * 10, "t", schema)
    assert (repeats.null_penalty, repeats.duplicate_penalty) == (0.0, 0.2)
    negative = score(spark, [(-1.0, str(i)) for i in range(10)], "t", schema)
    assert (negative.constraint_penalty, negative.quality_score) == (0.5, 0.5)


def test_score_averages_over_failing_columns_only(spark):
    row = score(spark, [(None, None, 1.0), (1.0, "x", 2.0), (2.0, "y", 3.0), (3.0, "z", 4.0)], "t", "a double, b string, c double")
    assert row.null_penalty == pytest.approx(2 / (4 * 2))


def test_null_and_constraint_rows(spark, rows):
    df = spark.createDataFrame([stock(qty=-1.0, safety=None), stock(qty=None)], INVENTORY)
    assert rows(quality.null_counts(df)) == [("quantity_on_hand", 1), ("safety_stock", 1)]
    assert rows(quality.constraint_counts(df, "silver.inventory_position")) == [("quantity_on_hand_negative", 1)]


def test_row_rules_and_gate(spark, rows):
    df = spark.createDataFrame([stock("a", qty=-1.0), stock("b", qty=1.0)], INVENTORY)
    failed = quality.run_rules(df, [quality.non_negative("quantity_on_hand", "NEG")], ["item_id"])
    assert rows(failed, "item_id", "check_id", "severity") == [("a", "NEG", "critical")]
    assert quality.may_publish(failed).first().can_publish is False
    fine = quality.run_rules(df.filter("item_id = 'b'"), [quality.non_negative("quantity_on_hand", "NEG")], ["item_id"])
    assert quality.may_publish(fine).first().can_publish is True


SUPPLIER = "business_key string, is_current boolean, load_ts timestamp_ntz"
NOW = "2024-01-01 00:10:00"
LOADED = dt.datetime(2024, 1, 1, 0, 9)


def tables(spark, shipments, keys=("C1",), stocks=()):
    return {
        "supplier": spark.createDataFrame([(k, True, LOADED) for k in keys], SUPPLIER),
        "shipment": spark.createDataFrame(shipments, SHIPMENT),
        "inventory_position": spark.createDataFrame(list(stocks) or [stock()], INVENTORY).withColumn("load_ts", F.lit(LOADED).cast("timestamp_ntz")),
    }


def verdict(spark, table, named):
    return gate.evaluate(gate.run_checks(spark, "silver", table, named, NOW), "silver", table, NOW).first()


def test_gate_open_blocked_and_warnings(spark):
    ok = verdict(spark, "shipment", tables(spark, [shipment("a", load="2024-01-01 00:09:00")]))
    assert (ok.status, ok.message, ok.evaluation_id) == ("open", "open", "silver_shipment_20240101_001000")
    orphan = verdict(spark, "shipment", tables(spark, [shipment("a", carrier="NOPE", load="2024-01-01 00:09:00")]))
    assert (orphan.status, orphan.can_publish, orphan.critical_failures) == ("blocked", False, 1)
    stale = verdict(spark, "shipment", tables(spark, [shipment("a", load="2023-01-01")]))
    assert (stale.can_publish, stale.message) == (True, "open, to be looked at: warnings 1, infos 0")


def test_gate_counts_nulls_in_uniqueness(spark):
    twice = tables(spark, [shipment(None), shipment("a")])
    by_id = {r.check_id: r for r in gate.run_checks(spark, "silver", "shipment", twice, NOW).collect()}
    assert by_id["COMPL002"].message == "shipment_id: 1 of 2 without a value"
    assert not by_id["UNIQ002"].passed


def test_a_table_is_read_once_for_its_row_checks(spark, tmp_path):
    path = str(tmp_path / "shipments")
    tables(spark, [shipment("a"), shipment("b", status="delivered")])["shipment"].write.parquet(path)
    named = tables(spark, [shipment("a")]) | {"shipment": spark.read.parquet(path)}
    more = [gate.Check(f"P{i}", "p", "info", "*", "*", "status", "predicate", violated=F.col("status") == "planned") for i in range(6)]
    checks = gate.checks_for("silver", "shipment", gate.with_checks(*more))
    results = gate.run_checks(spark, "silver", "shipment", named, NOW, checks)
    plan = results._jdf.queryExecution().executedPlan().toString()
    # one scan for ten row checks, one for each of shipment_id and carrier_id
    assert len(checks) == 11 and plan.count("FileScan parquet") == 3
    assert {r.check_id: r.failing_rows for r in results.collect() if r.check_id.startswith("P")} == {f"P{i}": 1 for i in range(6)}


def test_check_that_cannot_run_is_failed(spark):
    named = tables(spark, [shipment("a")])
    named["shipment"] = named["shipment"].drop("carrier_id")
    by_id = {r.check_id: r for r in gate.run_checks(spark, "silver", "shipment", named, NOW).collect()}
    assert not by_id["REF001"].passed and "carrier_id not found" in by_id["REF001"].message
    odd = gate.Check("ODD1", "odd", "critical", "silver", "shipment", "status", "unheard_of")
    assert gate.run_checks(spark, "silver", "shipment", named, NOW, [odd]).first().message == (
        "could not be run: Unknown check type: unheard_of")


def test_custom_checks_and_selection(spark):
    own = gate.Check("OWN1", "own", "info", "*", "*", "status", "predicate", violated=F.col("status") == "planned")
    chosen = gate.checks_for("silver", "supplier", gate.with_checks(own))
    assert [c.check_id for c in chosen] == ["COMPL001", "UNIQ001", "FRESH001", "OWN1"]
    row = gate.run_checks(spark, "silver", "shipment", tables(spark, [shipment("a")]), NOW, [own]).first()
    assert (row.passed, row.failing_rows) == (False, 1)
    assert gate.check_summary(spark).agg(F.sum("checks")).first()[0] == 9


def test_uniqueness_ignores_closed_versions(spark):
    named = tables(spark, [shipment("a")])
    named["supplier"] = spark.createDataFrame([("C1", True, LOADED), ("C1", False, LOADED)], SUPPLIER)
    assert verdict(spark, "supplier", named).can_publish


def test_history_filters_and_orders(spark):
    log = spark.createDataFrame([("silver", "a", dt.datetime(2024, 1, d)) for d in (1, 3, 2)] + [("gold", "a", dt.datetime(2024, 1, 9))],
                                "dataset string, table_name string, evaluation_time timestamp_ntz")
    assert [r.evaluation_time.day for r in gate.history(log, 2, dataset="silver").collect()] == [3, 2]


@pytest.mark.parametrize("age, expected", [(45, "ok"), (46, "warning"), (75, "warning"), (76, "breach")])
def test_freshness_boundaries(spark, age, expected):
    latest = spark.createDataFrame([("logistics", dt.datetime(2024, 1, 1))], "domain string, last_updated timestamp_ntz")
    now = str(dt.datetime(2024, 1, 1) + dt.timedelta(minutes=age))
    row = freshness.status(latest, now).first()
    assert (row.status, row.age_minutes) == (expected, age)


def test_freshness_missing_override_and_history(spark, rows):
    empty = spark.createDataFrame([], "load_ts timestamp_ntz")
    assert freshness.refresh({"inventory": empty}, NOW).first().status == "missing"
    own = {**freshness.SLAS, "returns": freshness.Sla(10, 5, 20)}
    full = spark.createDataFrame([(dt.datetime(2024, 1, 1),)], "load_ts timestamp_ntz")
    state = freshness.refresh({"returns": full}, NOW, own)
    assert state.first().status == "warning"
    later = freshness.refresh({"returns": full}, "2024-01-01 01:00:00", own)
    assert freshness.current(state.unionByName(later)).first().status == "breach"
    assert set(freshness.slas_for(["supplier"])) == {"supplier"}


RAW = ("shipment_id string, route_id string, carrier_id string, origin string, destination string, "
       "planned_departure string, status string, weight string")


def test_contract_errors_in_order(spark):
    df = spark.createDataFrame([("x" * 51, None, "c", "o", "d", "yesterday", "lost", "-2")], RAW)
    row = contracts.validate(df, CONTRACT["shipment_raw"]).first()
    assert [(e.field_path, e.error_type) for e in row._errors] == [
        ("route_id", "missing_required_field"), ("shipment_id", "max_length_violation"),
        ("planned_departure", "type_mismatch"), ("status", "invalid_value"), ("weight", "min_value_violation")]
    assert row._errors[1].message == "51 characters where 50 are the most"
    assert row._errors[4].message == "-2 is below 0.0"


def test_contract_split_keeps_every_row(spark):
    data = [("a", "r", "c", "o", "d", None, "planned", None), ("b", "r", None, "o", "d", None, "planned", "heavy")]
    df = spark.createDataFrame(data, RAW)
    valid, bad = contracts.split(df, CONTRACT["shipment_raw"])
    assert [r.shipment_id for r in valid.collect()] == ["a"]
    assert [r.shipment_id for r in bad.collect()] == ["b"]
    with pytest.raises(contracts.ContractError, match="carrier_id: missing_required_field"):
        contracts.assert_valid(df, CONTRACT["shipment_raw"])
    assert contracts.assert_valid(valid, CONTRACT["shipment_raw"]) is valid


def test_missing_required_column_fails_every_row(spark):
    df = spark.createDataFrame([("a",), ("b",)], "item_id string")
    got = {(r.field_path, r.error_type): r.error_count for r in contracts.error_counts(df, CONTRACT["inventory_raw"]).collect()}
    assert got[("location_id", "missing_required_field")] == 2


def test_region_length(spark):
    df = spark.createDataFrame([("s", "n", "active", "x" * 51), ("t", "n", "active", "North America")],
                               "supplier_id string, supplier_name string, status string, region string")
    assert contracts.summary(df, CONTRACT["supplier_raw"]).first().invalid_records == 1
    own = contracts.Contract("own", "any", ("supplier_id",), {"supplier_id": "string"}, {"supplier_id": {"max_length": 0}})
    assert contracts.summary(df, own).first().invalid_records == 2


def test_precheck(spark):
    df = spark.createDataFrame([], "a string")
    with pytest.raises(contracts.ContractError, match="no data"):
        contracts.precheck(df, ["a"], "t")
    with pytest.raises(contracts.ContractError, match="missing"):
        contracts.precheck(df, ["b"], "t")


def test_masking_is_least_privilege(spark):
    df = spark.createDataFrame([("n", "a@b.c", "+1-555", "EU")], "name string, contact_email string, contact_phone string, region string")
    assert gov.masked_for(df, "engineer").columns == df.columns
    analyst = gov.masked_for(df, "analyst").first()
    assert (analyst.name, len(analyst.contact_email), analyst.contact_phone) == ("n", 64, "+n-nnn")
    assert gov.masked_for(df, "auditor").columns == ["name", "region"]
    with pytest.raises(PermissionError):
        gov.masked_for(df, "external_partner")
    with pytest.raises(ValueError):
        gov.masked_for(df, "visitor")


def test_dictionary_covers_all_tables(spark):
    from stocktide import schemas

    rows = gov.data_dictionary(spark)
    assert rows.select("table_name").distinct().count() == len(schemas.TABLES)
    assert rows.filter("table_name = 'silver.shipment' AND partition_column").count() == 2
