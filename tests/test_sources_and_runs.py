import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from stocktide import schemas
from stocktide.operators import governance as gov, inventory as inv, shipments as shp, unified as uni
from stocktide.plans.runner import LINK, Job, Refused, run
from stocktide.sources import generate
from stocktide.sources.readers import DOMAINS, load, typed
from stocktide.sources.store import Store
from stocktide.streaming import streams

from test_cleaning import INVENTORY, SHIPMENT, shipment, stock

AS_OF = "2024-03-01 12:00:00"


def test_dirty_csv(spark, tmp_path):
    path = tmp_path / "inventory.csv"
    path.write_text(
        "location_id,item_id,snapshot_date,quantity_on_hand,safety_stock,in_transit_qty,colour\n"
        "W1,I1,2024-01-02,5.5,1,2,red\n"
        "W1,I2,02.01.2024,many,,2,\n")
    rows = typed(load(spark, "inventory", str(path), AS_OF), "inventory").orderBy("item_id").collect()
    assert (rows[0].item_id, rows[0].location_id, rows[0].snapshot_date, rows[0].quantity_on_hand) == (
        "I1", "W1", dt.date(2024, 1, 2), 5.5)
    assert (rows[1].snapshot_date, rows[1].quantity_on_hand, rows[1].safety_stock, rows[1].in_transit_qty) == (None, None, None, 2.0)
    assert rows[0].colour == "red" and rows[0].unit_cost is None
    assert rows[0]._source_file.endswith("inventory.csv") and rows[0]._source_system == "inventory_system"


def test_supplier_text_is_standardised(spark, tmp_path):
    path = tmp_path / "s.json"
    path.write_text(
        json.dumps({"supplier_id": "s1", "supplier_name": " acme ", "status": "Active", "region": "eu",
                    "last_updated": "2024-01-01 10:00:00"}) + "\n"
        + json.dumps({"supplier_id": "s2", "supplier_name": "b", "status": "pending", "region": "us", "attributes": '{"Tier": 1}'}) + "\n"
        + "{broken\n")
    rows = typed(load(spark, "supplier", str(path), AS_OF), "supplier").orderBy(F.col("supplier_id").asc_nulls_last()).collect()
    assert (rows[0].supplier_name, rows[0].status, rows[0].region, rows[0].attributes) == ("ACME", "active", "EU", "{}")
    assert rows[0].last_updated == dt.datetime(2024, 1, 1, 10)
    assert rows[1].attributes == '{"Tier": 1}'
    assert rows[2].supplier_id is None and rows[2]._corrupt_record == "{broken"


def test_unknown_format_and_domain(spark):
    with pytest.raises(ValueError, match="Unsupported file format"):
        load(spark, "supplier", "x.xml", AS_OF)
    with pytest.raises(ValueError, match="Unknown domain"):
        load(spark, "weather", "x.csv", AS_OF)


def test_generated_feeds(spark):
    s = generate.suppliers(spark, 5, AS_OF).orderBy("supplier_id").collect()
    assert (s[3].supplier_id, s[3].status, s[3].region, s[3].contact_phone) == ("SUP_000004", "active", "Latin America", "+1-555-0004")
    assert json.loads(s[4].attributes) == {"category": "electronics", "tier": 2}
    m = generate.shipments(spark, 12, AS_OF).orderBy("shipment_id").collect()
    assert (m[11].carrier_id, m[11].planned_departure, m[11].actual_arrival, m[11].weight) == (
        "CARR_002", "2024-03-12 12:00:00", "2024-03-14 14:00:00", 210.0)
    i = generate.inventory(spark, 3, AS_OF).orderBy("item_id").collect()
    assert (i[2].location_id, i[2].snapshot_date, i[2].available_qty, i[2].last_count_date) == ("WH003", "2024-02-28", 114.0, "2024-02-28")
    assert generate.initial_freshness(spark, AS_OF).filter("status = 'ok'").count() == 3


def test_clustered_layout_through_the_store(spark, tmp_path):
    import pyarrow.parquet as pq

    store, table = Store(spark, str(tmp_path)), "silver.snapshots"
    many = spark.range(20_000).select((F.col("id") * 7919 % 20_000).alias("k"))
    store.replace(gov.clustered(many, ["k"], 4), table, [], keep_layout=True)
    files = sorted(p for p in (tmp_path / "silver" / "snapshots" / "data").rglob("*.parquet"))
    spans = sorted((lambda c: (c[0].as_py(), c[-1].as_py(), c.to_pylist() == sorted(c.to_pylist())))(pq.read_table(f)["k"]) for f in files)
    assert len(spans) == 4 and all(s[2] for s in spans)
    assert all(a[1] < b[0] for a, b in zip(spans, spans[1:]))


def _ship(spark, path, ids, status):
    spark.createDataFrame([(i, "R", "C", "o", "d", status) for i in ids],
                          "shipment_id string, route_id string, carrier_id string, origin string, destination string, status string").write.json(path)


def test_backfill_and_repeated_ingest(spark, tmp_path):
    store = Store(spark, str(tmp_path / "lake"), buckets=4)
    one, two = str(tmp_path / "one.json"), str(tmp_path / "two.json")
    _ship(spark, one, ["a", "b"], "delivered")
    _ship(spark, two, ["b", "c"], "planned")
    late, early = Job(store, "2024-03-05 00:00:00"), Job(store, "2024-03-03 00:00:00")
    assert late.ingest("shipment", one) == 2 and late.ingest("shipment", one) == 2
    assert store.read_appended("bronze.shipment_raw").count() == 2
    assert late.conform("shipment") == 1 and late.conform("shipment") == 1
    assert early.ingest("shipment", two) == 2  # arrives later, of an earlier instant
    early.conform("shipment")
    assert {r.shipment_id: r.status for r in store.read("silver.shipment").collect()} == {"a": "delivered", "b": "delivered", "c": "planned"}
    assert store.read_appended("ops.schema_validation_log").count() == 2
    assert store.arrivals("bronze.shipment_raw", store.through("silver.shipment")) == []


def test_trusted_system_survives_at_one_instant(spark, tmp_path):
    store = Store(spark, str(tmp_path / "lake"), buckets=2)
    mapping = [("erp_system", "e1", "supplier", "BK", 1.0, True), ("wms_system", "w1", "supplier", "BK", 1.0, True)]
    crosswalk = spark.createDataFrame(mapping, "source_system string, source_key string, entity_type string, business_key string, "
                                               "confidence double, is_active boolean").withColumns({
        "created_ts": F.lit("2024-01-01").cast("timestamp_ntz"), "updated_ts": F.lit("2024-01-01").cast("timestamp_ntz")})
    store.replace(crosswalk, "silver.crosswalk", [])
    job = Job(store, AS_OF)
    for system, key, name in (("wms_system", "w1", "Alpha"), ("erp_system", "e1", "Zeta")):
        path = str(tmp_path / f"{key}.json")
        spark.createDataFrame([(key, name, "active", "Europe")], "supplier_id string, supplier_name string, status string, region string").write.json(path)
        job.ingest("supplier", path, source_system=system)
    job.conform("supplier")
    assert [(r.business_key, r.name) for r in store.read("silver.supplier_scd2").collect()] == [("BK", "ZETA")]


def brute_unified(positions, moves):
    out = []
    for item, supplier, day in positions:
        near = [m for m in moves if m[1] == supplier and abs((m[2] - dt.datetime.combine(day, dt.time())).total_seconds()) <= 7 * 86400]
        out += [(item, m[0]) for m in near] or [(item, None)]
    return sorted(out, key=repr)


def test_unified_join_equals_brute_force_under_skew(spark):
    import random

    rng = random.Random(3)
    start = dt.date(2024, 1, 1)
    suppliers = lambda: "HOT" if rng.random() < 0.5 else f"S{rng.randrange(5)}"
    positions = [(f"I{i}", suppliers(), start + dt.timedelta(days=rng.randrange(200))) for i in range(150)]
    moves = [(f"M{i}", suppliers(), dt.datetime(2024, 1, 1) + dt.timedelta(days=rng.randrange(200), hours=rng.choice([0, 0, 5, 23])))
             for i in range(60)]
    base = spark.createDataFrame(positions, "item_id string, supplier_id string, inventory_date date")
    ships = spark.createDataFrame([shipment(m[0], pd=str(m[2]), carrier=m[1], status="delivered") for m in moves], SHIPMENT)
    got = sorted(((r.item_id, r.shipment_id) for r in uni.attach_shipments(base, ships).collect()), key=repr)
    assert got == brute_unified(positions, moves)


def test_unified_plan_has_no_cross_join(spark):
    base = spark.createDataFrame([("I", "S", dt.date(2024, 1, 1))], "item_id string, supplier_id string, inventory_date date")
    ships = spark.createDataFrame([shipment("m", pd="2024-01-02", carrier="S")], SHIPMENT)
    plan = uni.attach_shipments(base, ships)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def _write_sources(spark, root):
    generate.suppliers(spark, 12, AS_OF).write.option("header", True).csv(f"{root}/suppliers.csv")
    moves = generate.shipments(spark, 40, "2024-02-20 08:00:00").withColumn(
        "carrier_id", F.concat(F.lit("SUP_"), F.lpad((F.crc32("shipment_id") % 12 + 1).cast("string"), 6, "0")))
    moves.write.json(f"{root}/shipments.json")
    generate.inventory(spark, 30, AS_OF).write.parquet(f"{root}/inventory.parquet")
    generate.inventory(spark, 30, AS_OF).select(
        "item_id", "location_id",
        F.concat(F.lit("SUP_"), F.lpad((F.crc32("item_id") % 12 + 1).cast("string"), 6, "0")).alias("supplier_id"),
    ).write.parquet(f"{root}/link.parquet")
    return {"supplier": f"{root}/suppliers.csv", "shipment": f"{root}/shipments.json", "inventory": f"{root}/inventory.parquet",
            "link": f"{root}/link.parquet"}


def test_whole_run(spark, tmp_path):
    sources = _write_sources(spark, tmp_path / "in")
    root = str(tmp_path / "lake")
    store = Store(spark, root)
    run(spark, root, "all", AS_OF, sources=sources)
    assert store.read("silver.supplier_scd2").filter("is_current").count() == 12
    assert store.read("silver.shipment").count() == 40
    unified = store.read("gold.unified_supply_chain")
    assert unified.select("item_id", "location_id").distinct().count() == 30
    assert unified.filter("supplier_id IS NULL").isEmpty()
    assert store.read("gold.shipment_performance").agg(F.sum("total_shipments")).first()[0] == 40
    assert store.read_appended("ops.publish_gate_log").filter("can_publish").count() == 3
    assert store.read_appended("ops.schema_validation_log").count() == 3
    lineage = {(r.target, r.source_table) for r in store.read_appended("ops.lineage").collect()}
    assert ("gold.shipment_performance", "silver.shipment") in lineage and ("gold.unified_supply_chain", LINK) in lineage
    assert len([x for x in lineage if x[0] == "gold.shipment_performance"]) == 1
    assert store.read_appended("ops.data_quality_status").filter("critical_checks_passed").count() == 3
    measured = {r.domain: r.rows_out for r in store.read_appended("ops.pipeline_metrics").collect()}
    assert measured["shipment"] == 40 and measured["unified_supply_chain"] == unified.count()
    assert store.read_appended("ops.freshness_status").count() == 3

    # a second run over the same bronze data changes no silver row
    before = {t: store.read(t).drop("created_at").collect() for t in ("silver.shipment", "silver.inventory_position", "silver.supplier_scd2")}
    run(spark, root, "silver", AS_OF)
    for table, rows in before.items():
        assert sorted(map(repr, store.read(table).drop("created_at").collect())) == sorted(map(repr, rows)), table

    # a late correction replaces its shipment
    job = Job(store, "2024-03-02 12:00:00")
    fix = [json.dumps({"shipment_id": "SHIP_000001", "route_id": "R", "carrier_id": "SUP_000001", "origin": "o",
                       "destination": "d", "status": "cancelled"}),
           json.dumps({"shipment_id": "SHIP_000002", "carrier_id": "SUP_000001", "status": "lost"})]
    (tmp_path / "fix.json").write_text("\n".join(fix))
    assert job.ingest("shipment", str(tmp_path / "fix.json")) == 1
    quarantined = store.read_appended("bronze.shipment_raw_quarantine").filter("shipment_id = 'SHIP_000002'").collect()
    assert len(quarantined) == 1 and "missing_required_field" in quarantined[0]._errors
    assert job.apply_late("shipment") is True
    after = {r.shipment_id: r for r in store.read("silver.shipment").collect()}
    assert len(after) == 40 and after["SHIP_000001"].status == "cancelled"
    assert Job(store, "2024-06-01 00:00:00").apply_late("shipment") is False


def test_blocked_gate_leaves_gold_untouched(spark, tmp_path):
    sources = _write_sources(spark, tmp_path / "in")
    store = Store(spark, str(tmp_path / "lake"))
    job = Job(store, AS_OF)
    for domain in ("shipment", "inventory"):
        job.ingest(domain, sources[domain])
        job.conform(domain)
    with pytest.raises(Refused, match="closed: critical checks failed"):
        job.publish()
    assert store.version("gold.unified_supply_chain") == 0
    assert store.read_appended("ops.alerts").count() == 1
    with pytest.raises(ValueError):
        job.publish("weather")
    with pytest.raises(ValueError):
        run(spark, str(tmp_path / "lake"), "platinum", AS_OF)
    assert set(DOMAINS) == {"supplier", "shipment", "inventory"}


def test_stream_upsert_over_many_batches_equals_batch(spark, tmp_path, rows):
    feed = [shipment(f"m{i % 7}", status=["planned", "in_transit", "delivered"][i % 3], load=f"2024-01-{1 + (i * 5) % 20:02d}") for i in range(40)]
    source = str(tmp_path / "in")
    for start in range(0, 40, 10):
        spark.createDataFrame(feed[start:start + 10], SHIPMENT).coalesce(1).write.mode("append").parquet(source)
    stream = streams.file_stream(spark, source, spark.createDataFrame([], SHIPMENT).schema, max_files=1)
    sink = streams.UpsertSink(spark, str(tmp_path / "out"), ["shipment_id"], [F.col("load_ts").desc()], prepare=shp.clean)
    sink.run(stream, str(tmp_path / "checkpoint"))
    want = spark.createDataFrame(feed, SHIPMENT)
    assert rows(sink.read().groupBy("shipment_id").agg(F.max("load_ts"))) == rows(want.groupBy("shipment_id").agg(F.max("load_ts")))
    assert len(list((tmp_path / "out").glob("batch_id=*"))) == 4

    # a restart reads only the file that is new
    spark.createDataFrame([shipment("m0", status="cancelled", load="2024-02-01")], SHIPMENT).coalesce(1).write.mode("append").parquet(source)
    sink.run(streams.file_stream(spark, source, spark.createDataFrame([], SHIPMENT).schema, max_files=1), str(tmp_path / "checkpoint"))
    assert len(list((tmp_path / "out").glob("batch_id=*"))) == 5
    latest = {r.shipment_id: r.status for r in sink.read().collect()}
    assert latest["m0"] == "cancelled"
    base = spark.createDataFrame([shipment("m0", load="2025-01-01"), shipment("zz")], SHIPMENT)
    merged = {r.shipment_id: r.status for r in sink.compacted(base).collect()}
    assert merged["m0"] == "planned" and "zz" in merged


def test_stream_drops_late_repeats_and_late_rows(spark, tmp_path, rows):
    schema = "id string, ts timestamp_ntz"
    source = str(tmp_path / "in")
    day = dt.datetime(2024, 1, 1)
    for batch in ([("a", day), ("b", day)], [("a", day + dt.timedelta(minutes=5)), ("c", day + dt.timedelta(hours=9))],
                  [("f", day + dt.timedelta(hours=9))], [("d", day)], [("e", day + dt.timedelta(hours=20))]):
        spark.createDataFrame(batch, schema).coalesce(1).write.mode("append").parquet(source)
    stream = streams.file_stream(spark, source, spark.createDataFrame([], schema).schema, max_files=1)
    streams.run_to_files(streams.without_repeats(stream, "ts", ["id"], "1 hour"), str(tmp_path / "o"), str(tmp_path / "c"))
    got = rows(spark.read.parquet(str(tmp_path / "o")), "id")
    # d arrives long behind the watermark (lateness is judged one batch behind), the second a within the hour of the first
    assert got == [("a",), ("b",), ("c",), ("e",), ("f",)]


def test_inventory_upsert_is_idempotent(spark, rows):
    new = spark.createDataFrame([stock("a", qty=2.0), stock("a", qty=3.0, load="2024-01-02")], INVENTORY)
    once = inv.upsert(spark.createDataFrame([], INVENTORY), new)
    assert rows(once, "quantity_on_hand") == [(3.0,)]
    assert rows(inv.upsert(once, new)) == rows(once)


def test_windows_left_open_are_written_by_a_later_run(spark, tmp_path):
    schema = "id string, ts timestamp_ntz"
    source, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "checkpoint"))
    day = dt.datetime(2024, 1, 1)

    def run_with(*hours):
        spark.createDataFrame([(str(h), day + dt.timedelta(hours=h)) for h in hours], schema).coalesce(1).write.mode("append").parquet(source)
        stream = streams.file_stream(spark, source, spark.createDataFrame([], schema).schema)
        streams.run_to_files(streams.tumbling_counts(stream, "ts", [], "1 hour", "10 minutes"), out, checkpoint)
        return {r.window_start.hour: r.events for r in spark.read.parquet(out).collect()}

    first = run_with(0.1, 0.2, 3.5)
    assert first == {0: 2}  # the window of 3.5 is open when the input ends
    assert run_with(9.0) == {0: 2, 3: 1}


def _suppliers(spark, path, *names):
    spark.createDataFrame([(k, n, "active", "EUROPE") for k, n in names], "supplier_id string, supplier_name string, status string, region string").write.json(path)


def test_minted_keys_go_in_force_with_the_history(spark, tmp_path):
    store = Store(spark, str(tmp_path / "lake"), buckets=2)
    known = spark.createDataFrame([("erp_system", "s1", "supplier", "BK1", 1.0, True)], "source_system string, source_key string, "
                                  "entity_type string, business_key string, confidence double, is_active boolean").withColumns({
        "created_ts": F.lit("2024-01-01").cast("timestamp_ntz"), "updated_ts": F.lit("2024-01-01").cast("timestamp_ntz")})
    store.replace(known, "silver.crosswalk", [])
    job = Job(store, AS_OF, mint=True)
    _suppliers(spark, str(tmp_path / "a.json"), ("s1", "One"), ("s2", "Two"))
    job.ingest("supplier", str(tmp_path / "a.json"), source_system="erp_system")
    commits = len(store.log.numbers())
    job.conform("supplier")
    both = [n for n in store.log.numbers()[commits:] if {"silver.crosswalk", "silver.supplier_scd2"} <= set(store.log.at(n)["tables"])]
    assert store.log.at(both[0])["number"] == commits + 1  # one commit holds both
    assert sorted(r.business_key for r in store.read("silver.supplier_scd2").collect()) == ["BK1", "SUPPLIER_erp_system_s2"]
    assert store.read("silver.crosswalk").count() == 2
    # the same suppliers again: nothing is minted, nothing changes
    again = Job(store, "2024-03-02 12:00:00", mint=True)
    again.ingest("supplier", str(tmp_path / "a.json"), source_system="erp_system")
    again.conform("supplier")
    assert store.read("silver.crosswalk").count() == 2 and store.read("silver.supplier_scd2").count() == 2


def test_a_key_mapped_meanwhile_is_not_minted(spark, tmp_path, monkeypatch):
    store = Store(spark, str(tmp_path / "lake"), buckets=2)
    job = Job(store, AS_OF, mint=True)
    _suppliers(spark, str(tmp_path / "a.json"), ("s1", "One"))
    job.ingest("supplier", str(tmp_path / "a.json"), source_system="erp_system")
    publish = store.publish

    def interrupted(*staged, **rest):
        monkeypatch.setattr(store, "publish", publish)
        store.replace(spark.createDataFrame([("erp_system", "s1", "supplier", "MAPPED", 1.0, True, dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 1))],
                                            "source_system string, source_key string, entity_type string, business_key string, confidence double, "
                                            "is_active boolean, created_ts timestamp_ntz, updated_ts timestamp_ntz"), "silver.crosswalk", [])
        return publish(*staged, **rest)

    monkeypatch.setattr(store, "publish", interrupted)
    job.conform("supplier")
    assert [r.business_key for r in store.read("silver.supplier_scd2").collect()] == ["MAPPED"]
    assert store.read("silver.crosswalk").count() == 1


def test_runs_of_two_jobs_both_count(spark, tmp_path, monkeypatch):
    store = Store(spark, str(tmp_path / "lake"), buckets=4)
    one, two = str(tmp_path / "one.json"), str(tmp_path / "two.json")
    _ship(spark, one, ["a", "b"], "planned")
    _ship(spark, two, ["b", "c"], "delivered")
    first, second = Job(store, "2024-03-03 00:00:00"), Job(Store(spark, store.root, buckets=4), "2024-03-05 00:00:00")
    first.ingest("shipment", one)
    publish = store.publish

    def interrupted(*staged, **rest):
        monkeypatch.setattr(store, "publish", publish)
        second.ingest("shipment", two)
        second.conform("shipment")  # works in both batches while the first job is about to publish the first
        return publish(*staged, **rest)

    monkeypatch.setattr(store, "publish", interrupted)
    first.conform("shipment")
    assert {r.shipment_id: r.status for r in store.read("silver.shipment").collect()} == {"a": "planned", "b": "delivered", "c": "delivered"}
    assert store.arrivals("bronze.shipment_raw", store.through("silver.shipment")) == []


def test_gold_tables_go_in_force_together_or_not_at_all(spark, tmp_path, monkeypatch):
    sources = _write_sources(spark, tmp_path / "in")
    root = str(tmp_path / "lake")
    run(spark, root, "all", AS_OF, sources=sources)
    store = Store(spark, root)
    gold = [t for t in store.log.latest()["tables"] if t.startswith("gold.")]
    before = {t: store.version(t) for t in gold}
    assert len(gold) == 4 and set(before.values()) == {1}
    commit = next(n for n in store.log.numbers() if any(t in store.log.at(n)["tables"] for t in gold))
    assert all(t in store.log.at(commit)["tables"] for t in gold)
    made = []
    real = Job._gold_frame

    def failing(self, name, recent_days):
        made.append(name)
        if len(made) == 3:
            raise RuntimeError("lost")
        return real(self, name, recent_days)

    monkeypatch.setattr(Job, "_gold_frame", failing)
    with pytest.raises(RuntimeError, match="lost"):
        Job(store, "2024-03-01 12:00:00").publish()
    assert len(made) == 3 and {t: store.version(t) for t in gold} == before
    monkeypatch.setattr(Job, "_gold_frame", real)
    Job(store, "2024-03-01 12:00:00").publish()
    assert {store.version(t) for t in gold} == {2}


def _feed_files(spark, source, schema, *batches):
    for batch in batches:
        spark.createDataFrame(batch, schema).coalesce(1).write.mode("append").parquet(source)


def test_late_rows_are_set_apart_and_replayed_once(spark, tmp_path, rows):
    schema, day, h = "id string, ts timestamp_ntz", dt.datetime(2024, 1, 1), lambda n: dt.datetime(2024, 1, 1) + dt.timedelta(hours=n)
    source, path, checkpoint = (str(tmp_path / n) for n in ("in", "split", "checkpoint"))
    split = streams.LateSplit(spark, path, "ts", "2 hours")

    def run_with(*batches):
        _feed_files(spark, source, schema, *batches)
        split.run(streams.file_stream(spark, source, spark.createDataFrame([], schema).schema, max_files=1), checkpoint)

    run_with([("a", h(0)), ("b", h(9))], [("c", h(8)), ("d", h(1)), ("e", None)], [("f", h(7)), ("g", day), ("h", h(20))])
    # what arrives in the batch that moves the mark isn't behind it; the mark of a batch is that of the batches before
    assert rows(split.on_time(), "id") == [("a",), ("b",), ("c",), ("e",), ("f",), ("h",)]
    assert rows(split.late(), "id") == [("d",), ("g",)]
    taken = []
    assert split.replay(lambda df: taken.append(rows(df, "id"))) == 2
    assert split.replay(lambda df: taken.append(rows(df, "id"))) == 2
    assert taken == [[("d",), ("g",)]]
    run_with([("i", h(10)), ("j", h(19))])
    with pytest.raises(RuntimeError):
        split.replay(lambda df: (_ for _ in ()).throw(RuntimeError("lost")))
    split.replay(lambda df: taken.append(rows(df, "id")))
    assert taken[1:] == [[("i",)]]
    assert split.on_time().count() + split.late().count() == 10  # every row that was read
    # a batch that comes again finds its watermark and takes its own place
    split.write_batch(spark.createDataFrame([("f", h(7)), ("g", day), ("h", h(20))], schema), 2)
    assert split.on_time().count() + split.late().count() == 10 and rows(split.late(), "id") == [("d",), ("g",), ("i",)]


def test_late_rows_reach_the_silver_table(spark, tmp_path):
    store = Store(spark, str(tmp_path / "lake"), buckets=2)
    split = streams.LateSplit(spark, str(tmp_path / "split"), "load_ts", "1 day")
    batches = [[shipment("m0", load="2024-01-05")], [shipment("m0", status="delivered", load="2024-01-06"), shipment("late", load="2024-01-01")]]
    for k, batch in enumerate(batches):
        split.write_batch(spark.createDataFrame(batch, SHIPMENT), k)

    def into_silver(df):
        store.publish(store.stage_run(shp.newest(df), "silver.shipment", ["shipment_id"], "latest", ["load_ts"]))

    into_silver(split.on_time().drop("batch_id"))
    assert [r.shipment_id for r in store.read("silver.shipment").collect()] == ["m0"]
    split.replay(into_silver)
    assert {r.shipment_id: r.status for r in store.read("silver.shipment").collect()}.keys() == {"m0", "late"}


def test_stream_upsert_merges_its_batches(spark, tmp_path, rows):
    sink = streams.UpsertSink(spark, str(tmp_path / "out"), ["shipment_id"], [F.col("load_ts").desc()], compact_every=5)
    feed = [[shipment(f"m{(b * 3 + i) % 11}", status=["planned", "in_transit", "delivered"][(b + i) % 3], load=f"2024-01-{1 + (b * 7) % 20:02d}")
             for i in range(4)] for b in range(23)]
    for b, batch in enumerate(feed):
        sink.write_batch(spark.createDataFrame(batch, SHIPMENT), b)
        assert len([x for x in sink._batches() if x > sink._base()["through"]]) < 5
    assert sink._base()["through"] == 19 and len(sink._batches()) < 10
    assert len([n for n in sink.log.files.names(f"{sink.path}/base") if n.startswith("v=")]) <= 2
    best, columns = {}, spark.createDataFrame([], SHIPMENT).columns
    for b, batch in enumerate(feed):
        for row in batch:
            r = dict(zip(columns, row))
            held = best.get(r["shipment_id"])
            if held is None or (r["load_ts"], b) > held[0]:
                best[r["shipment_id"]] = ((r["load_ts"], b), r["status"])
    assert {r.shipment_id: r.status for r in sink.read().collect()} == {k: v[1] for k, v in best.items()}
    before = rows(sink.read())
    sink.write_batch(spark.createDataFrame([shipment("m0", status="cancelled", load="2030-01-01")], SHIPMENT), 7)  # replayed: it is in the base
    assert rows(sink.read()) == before
    assert sink.compact() == 22 and sink.compact() == 22 and rows(sink.read()) == before
