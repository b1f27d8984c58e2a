"""Gold tables made part by part: the rows are those made at once, and what a part has shuffled goes before the next."""

import glob

from pyspark.sql import functions as F

from stocktide.operators import common, unified as uni
from stocktide.plans import runner
from stocktide.plans.runner import GOLD, Job, run
from stocktide.sources.store import Store

from test_sources_and_runs import AS_OF, _write_sources


def test_parts_hold_every_row_once(spark, rows):
    df = spark.range(500).selectExpr("if(id % 7 = 0, null, id % 40) as k", "id as v")
    parts = common.in_parts(df, ["k"], 4)
    held = [rows(p, "v") for p in parts]
    assert sorted((v for p in held for v in p), key=repr) == rows(df, "v") and all(held)
    keys = [{r[0] for r in p.select("k").collect()} for p in parts]
    assert sum(map(len, keys)) == len(set().union(*keys))  # a key is in one part
    assert common.in_parts(df, ["k"], 1) == [df] and common.parts_of(0, 8) == 1 and common.parts_of(10**9, 8) == 8


def test_a_staged_part_lets_its_shuffle_go(spark, tmp_path):
    store = Store(spark, f"{tmp_path}/lake")

    def shuffled():
        files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return sum(files.apply(i).length() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_"))

    def summed(df):
        return df.groupBy("k").agg(F.max("v").alias("v"))

    df = spark.range(200_000).selectExpr("id * 7919 % 200003 as k", "cast(rand(5) * 1e15 as bigint) as v")
    runner.release(spark)
    before = shuffled()
    summed(df).write.parquet(f"{tmp_path}/whole")
    one = shuffled() - before
    runner.release(spark)
    before = shuffled()
    staged = store.stage([summed(p) for p in common.in_parts(df, ["k"], 4)], "work.x", [])
    assert one > 1_000_000 and shuffled() - before < one / 4  # of all parts, not even one part's shuffle is left
    assert sorted(map(tuple, store.read_staged(staged).collect())) == sorted(map(tuple, spark.read.parquet(f"{tmp_path}/whole").collect()))


def test_ranges_of_days_give_all_joined_rows(spark, rows):
    base = spark.range(400).selectExpr(
        "concat('I', id) as item_id", "if(id % 11 = 0, null, concat('S', id % 5)) as supplier_id",
        "if(id % 13 = 0, null, date_add(date'2024-01-01', cast(id % 90 as int))) as inventory_date")
    moves = spark.range(150).selectExpr(
        "concat('M', id) as shipment_id", "concat('S', id % 6) as carrier_id", "'delivered' as status", "'w' as source_system",
        "if(id % 17 = 0, null, cast(date'2023-12-20' as timestamp_ntz) + make_dt_interval(cast(id * 3 % 110 as int), cast(id % 3 * 12 as int))) as planned_departure_ts",
        "cast(date'2024-01-01' as timestamp_ntz) as load_ts")
    whole = rows(uni.attach_shipments(base, moves))
    ranges = uni.by_days(base, moves, 5)
    assert len(ranges) == 5 and all(mine.count() for mine, _ in ranges)
    assert sorted((r for mine, near in ranges for r in rows(uni.attach_shipments(mine, near))), key=repr) == whole
    assert uni.by_days(base.limit(0), moves.limit(0), 5)[0][0].count() == 0


def test_gold_in_parts_and_at_once(spark, tmp_path, rows, monkeypatch):
    sources = _write_sources(spark, tmp_path / "in")
    run(spark, str(tmp_path / "lake"), "all", AS_OF, sources=sources, recent_days=None)
    store = Store(spark, str(tmp_path / "lake"))
    columns = {n: sorted(store.read(f"gold.{n}").columns) for n in GOLD}
    whole = {n: rows(store.read(f"gold.{n}"), *columns[n]) for n in GOLD}
    assert glob.glob(f"{tmp_path}/lake/gold/shipment_performance/data/v=*/carrier_id=*")
    calls, positions = [], uni.positions
    monkeypatch.setattr(uni, "positions", lambda *a, **k: calls.append(1) or positions(*a, **k))
    monkeypatch.setattr(common, "PART_ROWS", 20)
    monkeypatch.setattr(runner, "FOLDERS", 5)
    Job(store, AS_OF).publish("all", None)
    assert len(calls) == 4  # once per part of 70 rows; every table made its own before
    assert {n: rows(store.read(f"gold.{n}"), *columns[n]) for n in GOLD} == whole
    newest = store._state("gold.shipment_performance")["folder"]
    assert glob.glob(f"{tmp_path}/lake/gold/shipment_performance/data/{newest}/part-*")  # no folder per carrier
    assert not glob.glob(f"{tmp_path}/lake/work/positions/data/*")
