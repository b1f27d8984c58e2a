import datetime as dt

import pytest
from pyspark.sql import functions as F

from stocktide.functions import labels
from stocktide.functions.timeexpr import hours_between, parse_date, parse_ts, seconds_between, ts, whole_minutes_between
from stocktide.operators import inventory as inv, shipments as shp

SHIPMENT = ("shipment_id string, route_id string, carrier_id string, origin string, destination string, "
            "planned_departure_ts timestamp_ntz, actual_departure_ts timestamp_ntz, planned_arrival_ts timestamp_ntz, "
            "actual_arrival_ts timestamp_ntz, status string, load_ts timestamp_ntz, source_system string")
INVENTORY = ("item_id string, location_id string, snapshot_date date, quantity_on_hand double, safety_stock double, "
             "in_transit_qty double, load_ts timestamp_ntz, source_system string")


def at(text):
    return dt.datetime.fromisoformat(text)


def shipment(sid="S1", pd=None, ad=None, pa=None, aa=None, status="planned", load="2024-01-01", carrier="C1", route="R1"):
    times = [at(x) if x else None for x in (pd, ad, pa, aa)]
    return (sid, route, carrier, "A", "B", *times, status, at(load), "wms_system")


def stock(item="I1", loc="W1", day="2024-01-01", qty=1.0, safety=1.0, transit=0.0, load="2024-01-01"):
    return (item, loc, dt.date.fromisoformat(day), qty, safety, transit, at(load), "wms_system")


def test_status_outside_domain_becomes_planned(spark, rows):
    df = spark.createDataFrame([shipment("a", status="LOST"), shipment("b", status=None), shipment("c", status="delivered")], SHIPMENT)
    assert rows(shp.clean(df), "shipment_id", "status") == [("a", "planned"), ("b", "planned"), ("c", "delivered")]


def test_departure_after_arrival_is_repaired(spark):
    df = spark.createDataFrame([shipment(pd="2024-01-05", pa="2024-01-03", ad="2024-01-02", aa=None)], SHIPMENT)
    row = shp.clean(df).first()
    assert row.planned_departure_ts == at("2024-01-03")
    assert row.actual_departure_ts == at("2024-01-02")


def test_missing_column_raises(spark):
    with pytest.raises(ValueError, match="carrier_id"):
        shp.clean(spark.createDataFrame([shipment()], SHIPMENT).drop("carrier_id"))


def test_missing_load_time_is_filled(spark):
    df = spark.createDataFrame([shipment()], SHIPMENT).drop("load_ts")
    assert shp.clean(df, "2024-02-02 03:04:05").first().load_ts == at("2024-02-02 03:04:05")


def test_upsert_keeps_latest_and_rerun_changes_nothing(spark, rows):
    old = spark.createDataFrame([shipment("a", load="2024-01-01"), shipment("b", load="2024-01-01")], SHIPMENT)
    new = spark.createDataFrame([shipment("a", status="delivered", load="2024-01-02"), shipment("c")], SHIPMENT)
    once = shp.upsert(old, new)
    assert rows(once, "shipment_id", "status") == [("a", "delivered"), ("b", "planned"), ("c", "planned")]
    assert rows(shp.upsert(once, new)) == rows(once)


def test_late_correction_does_not_undo_newer_row(spark, rows):
    held = spark.createDataFrame([shipment("a", status="delivered", load="2024-01-05")], SHIPMENT)
    older = spark.createDataFrame([shipment("a", status="in_transit", load="2024-01-02")], SHIPMENT)
    assert rows(shp.upsert(held, older), "status") == [("delivered",)]


def test_delayed_uses_hours(spark, rows):
    df = spark.createDataFrame([
        shipment("exact", pd="2024-01-01 00:00:00", ad="2024-01-02 00:00:00", status="in_transit"),
        shipment("over", pd="2024-01-01 00:00:00", ad="2024-01-02 00:00:01", status="in_transit"),
        shipment("done", pd="2024-01-01 00:00:00", ad="2024-01-09 00:00:00", status="delivered"),
    ], SHIPMENT)
    assert rows(shp.delayed(df, 24), "shipment_id") == [("over",)]


def test_delay_across_midnight(spark):
    df = spark.createDataFrame([shipment(pa="2024-01-01 23:30:00", aa="2024-01-02 00:30:00", status="delivered")], SHIPMENT)
    row = df.select(
        labels.delay_days(F.col("planned_arrival_ts"), F.col("actual_arrival_ts")).alias("d"),
        hours_between(F.col("planned_arrival_ts"), F.col("actual_arrival_ts")).alias("h"),
    ).first()
    assert (row.d, row.h) == (1, 1.0)


def test_delivery_metrics(spark):
    df = spark.createDataFrame([
        shipment("a", pa="2024-01-01 10:00:00", aa="2024-01-01 09:00:00", status="delivered"),
        shipment("b", pa="2024-01-01 10:00:00", aa="2024-01-01 13:00:00", status="delivered"),
        shipment("c", pa="2024-01-01 10:00:00", aa=None, status="delivered"),
    ], SHIPMENT)
    row = shp.delivery_metrics(df).first()
    assert (row.total_shipments, row.on_time_rate, row.avg_delay_hours) == (2, 0.5, 1.0)


def test_seconds_do_not_depend_on_session_zone(spark):
    # 2024-03-10 02:30 does not exist in New York
    df = spark.sql("SELECT TIMESTAMP_NTZ'2024-03-10 02:30:00' AS a, TIMESTAMP_NTZ'2024-03-10 04:00:00' AS b")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert df.select(seconds_between(F.col("a"), F.col("b"))).first()[0] == 5400
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_minutes_are_cut_towards_zero(spark):
    df = spark.sql("SELECT TIMESTAMP_NTZ'2024-01-01 00:00:00' AS a")
    got = df.select(*[whole_minutes_between(F.col("a"), ts(x)) for x in
                      ("2024-01-01 00:01:59", "2023-12-31 23:58:01", "2024-01-01 00:02:00")]).first()
    assert tuple(got) == (1, -1, 2)


def test_bad_text_parses_to_null(spark):
    df = spark.createDataFrame([("2024-01-02 03:04:05", "2024-01-02"), ("soon", "2024-13-01"), (None, None)], "t string, d string")
    got = [tuple(r) for r in df.select(parse_ts(F.col("t")), parse_date(F.col("d"))).collect()]
    assert got == [(at("2024-01-02 03:04:05"), dt.date(2024, 1, 2)), (None, None), (None, None)]


def test_inventory_negatives_and_nulls_become_zero(spark):
    row = inv.clean(spark.createDataFrame([stock(qty=-3.0, safety=None, transit=2.5)], INVENTORY)).first()
    assert (row.quantity_on_hand, row.safety_stock, row.in_transit_qty) == (0.0, 0.0, 2.5)


@pytest.mark.parametrize("qty, safety, view, gold", [
    (0.0, None, "stockout", "stockout"), (0.0, 0.0, "at_risk", "stockout"), (0.0, 5.0, "at_risk", "stockout"),
    (0.0, -1.0, "stockout", "stockout"), (4.0, 5.0, "at_risk", "at_risk"), (6.0, 5.0, "healthy", "healthy"),
    (6.0, None, "healthy", "healthy"),
])
def test_stock_labels_in_both_orders(spark, qty, safety, view, gold):
    df = spark.createDataFrame([(qty, safety)], "q double, s double")
    row = df.select(labels.stock_label_safety_first(F.col("q"), F.col("s")), labels.stock_label(F.col("q"), F.col("s"))).first()
    assert tuple(row) == (view, gold)


def test_latest_and_ties(spark, rows):
    df = spark.createDataFrame([
        stock(day="2024-01-01", qty=1.0), stock(day="2024-01-02", qty=2.0, load="2024-01-02"),
        stock(day="2024-01-02", qty=3.0, load="2024-01-03"), stock("I2", qty=9.0),
    ], INVENTORY)
    assert rows(inv.latest(df), "item_id", "quantity_on_hand") == [("I1", 3.0), ("I2", 9.0)]
    assert rows(inv.latest_with_ties(df), "item_id", "quantity_on_hand") == [("I1", 2.0), ("I1", 3.0), ("I2", 9.0)]
    assert rows(inv.latest(df, item_id="I2"), "item_id") == [("I2",)]


def test_latest_limits_groups_before_the_shuffle(spark):
    plan = inv.latest(spark.range(10).selectExpr(
        "string(id % 3) AS item_id", "string(id % 2) AS location_id", "DATE'2024-01-01' AS snapshot_date", "1D AS quantity_on_hand",
        "1D AS safety_stock", "1D AS in_transit_qty", "TIMESTAMP_NTZ'2024-01-01' AS load_ts", "'w' AS source_system",
    ))._jdf.queryExecution().executedPlan().toString()
    before_shuffle = plan[plan.index("Exchange"):]
    assert "WindowGroupLimit" in before_shuffle and "Partial" in before_shuffle


def test_turnover(spark, rows):
    df = spark.createDataFrame([
        stock("two", day="2024-01-30", qty=4.0), stock("two", day="2024-01-31", qty=6.0),
        stock("one", day="2024-01-31", qty=6.0), stock("old", day="2023-01-01"), stock("old", day="2023-01-02"),
        stock("none", day="2024-01-30", qty=0.0), stock("none", day="2024-01-31", qty=0.0),
    ], INVENTORY)
    got = rows(inv.turnover(df, "2024-01-31", 30), "item_id", "avg_inventory", "turnover_rate", "days_in_inventory")
    assert got == [("none", 0.0, 0.0, 0.0), ("one", None, 0.0, 0.0), ("two", 5.0, 0.2, 5.0)]


def test_cost_ranges_are_half_open(spark, rows):
    df = spark.createDataFrame([stock(day="2024-01-09"), stock(day="2024-01-10", load="2024-01-10"), stock(day="2023-01-01")], INVENTORY)
    costs = spark.createDataFrame(
        [("I1", at("2024-01-01"), at("2024-01-10"), "USD", 2.0), ("I1", at("2024-01-10"), None, "USD", 3.0)],
        "item_id string, effective_start_ts timestamp_ntz, effective_end_ts timestamp_ntz, cost_currency string, unit_cost double")
    assert rows(inv.cost_overlay(df, costs), F.dayofmonth("snapshot_date"), "unit_cost") == [(1, None), (10, 3.0), (9, 2.0)]
