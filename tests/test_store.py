"""Commits, runs, compaction and splitting of the store."""

import json
import threading

import pytest
from pyspark.sql import functions as F

from stocktide import schemas
from stocktide.operators import inventory as inv
from stocktide.sources.commits import CommitLog, Conflict
from stocktide.sources.store import LATEST, REPLACE, Store

from test_cleaning import INVENTORY, stock

TABLE = "silver.inventory_position"
KEYS = ["item_id"]


def items(spark, names, qty=1.0, load="2024-01-01"):
    return spark.createDataFrame([stock(n, qty=qty, load=load) for n in names], INVENTORY)


def put(store, df, merge=LATEST, through=None):
    return store.publish(store.stage_run(df, TABLE, KEYS, merge, ["load_ts"], through))


def runs(store):
    return {b: r for b, r in store._state(TABLE)["buckets"].items() if r}


def test_commits_of_many_writers_all_count(spark, tmp_path):
    def write(k):
        log = CommitLog(spark, str(tmp_path))
        for _ in range(5):
            log.commit({f"t{k}": lambda s: {"n": (s or {"n": 0})["n"] + 1}, "both": lambda s: {"n": (s or {"n": 0})["n"] + 1}})

    threads = [threading.Thread(target=write, args=(k,)) for k in range(4)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    log = CommitLog(spark, str(tmp_path))
    latest = log.latest()
    assert latest["number"] == 20 and log.numbers() == list(range(1, 21))
    assert log.state(latest, "both")["n"] == 20 and all(log.state(latest, f"t{k}")["n"] == 5 for k in range(4))
    assert log.state(log.at(7), "both")["version"] == 7


def test_store_versions(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    assert store.read(TABLE).isEmpty() and store.read(TABLE).columns == schemas.TABLES[TABLE].names
    assert store.replace(items(spark, "ab"), TABLE) == 1
    assert store.replace(store.read(TABLE).filter("item_id = 'a'"), TABLE) == 2
    assert [r.item_id for r in store.read(TABLE).collect()] == ["a"]
    assert store.read(TABLE, 1).count() == 2
    staged = store.stage(items(spark, "ab"), TABLE)
    assert store.version(TABLE) == 2 and store.read(TABLE, staged).count() == 2 and int(staged) == 3
    with pytest.raises(ValueError, match="no version"):
        store.read(TABLE, 9)


def test_two_writers_of_a_whole_table(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    a, b = store.stage(items(spark, "a"), TABLE, expected=0), store.stage(items(spark, "bc"), TABLE, expected=0)
    store.publish(a)
    with pytest.raises(Conflict):
        store.publish(b)
    assert store.read(TABLE).count() == 1 and store.read(TABLE, b).count() == 2
    store.publish(store.stage(items(spark, "bc"), TABLE))  # a writer that replaces whatever is there
    assert store.read(TABLE).count() == 2


def test_damage_is_not_taken_for_an_absent_table(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    store.replace(items(spark, "a"), TABLE)
    store.log.files.delete(f"{store.path(TABLE)}/data")
    with pytest.raises(Exception, match="(?i)exist"):
        store.read(TABLE)
    for name in store.log.files.names(f"{store.root}/_states"):
        store.log.files.delete(f"{store.root}/_states/{name}")
    with pytest.raises(Exception, match="(?i)exist"):
        Store(spark, str(tmp_path)).read(TABLE)


def test_a_batch_writes_its_own_rows_only(spark, tmp_path, rows):
    store = Store(spark, str(tmp_path), buckets=8)
    held = items(spark, [f"i{k}" for k in range(400)])
    put(store, held)
    before = runs(store)
    assert len(before) == 8 and all(len(r) == 1 for r in before.values()) and rows(store.read(TABLE)) == rows(held)
    batch = items(spark, ["i7", "i8", "new"], 5.0, "2024-01-02")
    staged = store.stage_run(batch, TABLE, KEYS, LATEST, ["load_ts"])
    assert sum(staged.buckets.values()) == 3
    store.publish(staged)
    assert sum(r["rows"] for rs in runs(store).values() for r in rs) == 403
    want = rows(held.where("item_id not in ('i7', 'i8')").union(batch))
    assert rows(store.read(TABLE)) == want
    assert rows(store.read(TABLE, 1)) == rows(held)
    assert store.compact(TABLE, everything=True) == len(staged.buckets)
    assert rows(store.read(TABLE)) == want and all(len(r) == 1 for r in runs(store).values())
    put(store, items(spark, ["i7"], 9.0, "2023-01-01"))  # an older row changes nothing
    assert rows(store.read(TABLE)) == want


def test_runs_are_merged_by_tiers_and_reads_stay_the_same(spark, tmp_path, rows):
    store = Store(spark, str(tmp_path), buckets=2, fanout=3)
    feed = []
    for k in range(14):
        batch = [stock(f"i{(k * 5 + j) % 17}", qty=float(k), load=f"2024-01-{1 + (k * 7) % 20:02d}") for j in range(6)]
        feed += batch
        put(store, inv.newest(spark.createDataFrame(batch, INVENTORY)))
        store.compact(TABLE)
        assert all(len(r) <= 6 for r in runs(store).values())
        tiers = [[x["tier"] for x in r] for r in runs(store).values()]
        assert all(t == sorted(t, reverse=True) for t in tiers)
    assert max(t[0] for t in tiers) >= 2
    from stocktide.operators.common import first_per_key

    want = first_per_key(spark.createDataFrame(feed, INVENTORY), KEYS, [F.col("load_ts").desc_nulls_last()])
    columns = ["item_id", "load_ts", "quantity_on_hand"]
    assert rows(store.read(TABLE), *columns) == rows(want, *columns)


def test_buckets_split_as_they_grow(spark, tmp_path, rows):
    store = Store(spark, str(tmp_path), buckets=1, split_rows=50, fanout=2)
    assert len(store._directory(None)) == 1
    everything = []
    for k in range(4):
        batch = [f"i{k}_{j}" for j in range(100)]
        everything += batch
        put(store, items(spark, batch))
        store.compact(TABLE)
    counts = {b: sum(r["rows"] for r in rs) for b, rs in runs(store).items()}
    assert len(counts) >= 8 and len({b.split("-")[0] for b in counts}) >= 1 and max(counts.values()) < 100
    got = store.read(TABLE)
    assert sorted(r.item_id for r in got.collect()) == sorted(everything)
    # every row lies in the bucket of its key
    names = list(store._state(TABLE)["buckets"])
    for bucket in list(counts)[:4]:
        assert [r.b for r in store.read(TABLE, buckets=[bucket]).select(store.bucket_of(KEYS, names).alias("b")).distinct().collect()] == [bucket]
    put(store, items(spark, everything, 2.0, "2024-02-01"))
    assert store.read(TABLE).where("quantity_on_hand = 2.0").count() == 400


def test_buckets_of_different_depths(spark):
    df = spark.range(2000).select(F.col("id").cast("string").alias("k"))
    h = F.pmod(F.xxhash64("k"), F.lit(1 << 24))
    want = F.when(h % 2 == 1, "1-1").when(h % 4 == 2, "2-2").when(h % 8 == 0, "3-0").otherwise("3-4")
    assert df.where(Store.bucket_of(["k"], ["1-1", "2-2", "3-0", "3-4"]) != want).isEmpty()
    assert df.select(Store.bucket_of(["k"], ["0-0"]).alias("b")).distinct().collect() == [("0-0",)]


def test_two_writers_of_a_keyed_table(spark, tmp_path):
    store = Store(spark, str(tmp_path), buckets=4)
    put(store, items(spark, "abcdef"))
    one = store.stage_run(items(spark, "a", 5.0, "2024-01-05"), TABLE, KEYS, LATEST, ["load_ts"])
    two = store.stage_run(items(spark, "b", 6.0, "2024-01-05"), TABLE, KEYS, LATEST, ["load_ts"])
    same = store.stage_run(items(spark, "a", 7.0, "2024-01-06"), TABLE, KEYS, LATEST, ["load_ts"])
    for staged in (one, two, same):  # the later ones are put on top of what the first left
        store.publish(staged)
    got = {r.item_id: r.quantity_on_hand for r in store.read(TABLE).collect()}
    assert got == {"a": 7.0, "b": 6.0, "c": 1.0, "d": 1.0, "e": 1.0, "f": 1.0}


def test_replacing_runs_conflict_on_one_bucket_only(spark, tmp_path):
    store = Store(spark, str(tmp_path), buckets=16)
    held = items(spark, [f"i{k}" for k in range(40)])
    put(store, held, REPLACE)
    names = list(store._state(TABLE)["buckets"])
    of = {r.item_id: r.b for r in held.select("item_id", store.bucket_of(KEYS, names).alias("b")).collect()}
    other = next(k for k in of if of[k] != of["i0"])
    first = store.stage_run(items(spark, ["i0"], 2.0).union(items(spark, ["i0"], 3.0)), TABLE, KEYS, REPLACE)
    second = store.stage_run(items(spark, [other], 4.0), TABLE, KEYS, REPLACE)
    third = store.stage_run(items(spark, ["i0"], 5.0), TABLE, KEYS, REPLACE)
    store.publish(first)
    store.publish(second)
    with pytest.raises(Conflict, match="changed by another writer"):
        store.publish(third)
    got = sorted((r.item_id, r.quantity_on_hand) for r in store.read(TABLE).where(F.col("item_id").isin("i0", other)).collect())
    assert got == sorted([("i0", 2.0), ("i0", 3.0), (other, 4.0)])  # the newest run has all rows of its key
    store.compact(TABLE, everything=True)
    assert store.read(TABLE).count() == 41


def test_a_merge_lets_later_batches_stay_on_top(spark, tmp_path, monkeypatch):
    store = Store(spark, str(tmp_path), buckets=1, fanout=2)
    put(store, items(spark, "ab"))
    put(store, items(spark, "bc", 2.0, "2024-01-02"))
    publish = store.publish

    def interrupted(*staged, **rest):
        monkeypatch.setattr(store, "publish", publish)
        put(store, items(spark, "c", 9.0, "2024-01-03"))  # comes while the merge is being written
        return publish(*staged, **rest)

    monkeypatch.setattr(store, "publish", interrupted)
    assert store.compact(TABLE) == 1
    assert [r["tier"] for r in runs(store)["0-0"]] == [1, 0]
    assert {r.item_id: r.quantity_on_hand for r in store.read(TABLE).collect()} == {"a": 1.0, "b": 2.0, "c": 9.0}


def test_runs_on_a_table_that_was_written_whole(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    store.replace(items(spark, "abc"), TABLE, [])
    put(store, items(spark, "c", 5.0, "2024-02-01"))
    assert sorted((r.item_id, r.quantity_on_hand) for r in store.read(TABLE).collect()) == [("a", 1.0), ("b", 1.0), ("c", 5.0)]
    store.compact(TABLE, everything=True)
    assert store.read(TABLE).count() == 3


def test_arrivals_are_worked_in_once(spark, tmp_path):
    store = Store(spark, str(tmp_path), buckets=1)
    store.put_batch(items(spark, "a"), "bronze.x", "one", arrived="2024-01-01")
    store.put_batch(items(spark, "b"), "bronze.x", "two", arrived="2023-01-01")
    store.put_batch(items(spark, "a"), "bronze.x", "one", arrived="2024-01-01")
    found = store.arrivals("bronze.x")
    assert [b for _, b, _ in found] == ["two", "one"] and store.read_appended("bronze.x", ["two"]).count() == 1
    through = (0, found[-1][0])
    one = store.stage_run(items(spark, "ab"), TABLE, KEYS, LATEST, ["load_ts"], through)
    two = store.stage_run(items(spark, "ab"), TABLE, KEYS, LATEST, ["load_ts"], through)
    store.publish(one)
    with pytest.raises(Conflict, match="worked in"):
        store.publish(two)
    assert store.arrivals("bronze.x", store.through(TABLE)) == [] and store.read(TABLE).count() == 2


def test_columns_of_append_tables_are_recorded(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    store.append(spark.createDataFrame([(1, "x")], "a int, p string"), "ops.t", ["p"])
    store.append(spark.createDataFrame([(2, "y", "new")], "a int, p string, b string"), "ops.t", ["p"])
    assert sorted(map(tuple, store.read_appended("ops.t").select("a", "b", "p").collect())) == [(1, None, "x"), (2, "new", "y")]
    with pytest.raises(ValueError, match="other types"):
        store.append(spark.createDataFrame([("s",)], "a string"), "ops.t", [])
    before = store.log.latest()["number"]
    store.append(spark.createDataFrame([(3,)], "a int"), "ops.t", [])
    assert store.log.latest()["number"] == before  # nothing new to record


def test_tables_go_in_force_together_and_a_view_stays_as_it_was(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    store.publish(store.stage(items(spark, "a"), "gold.x", []), store.stage(items(spark, "a"), "gold.y", []))
    view = store.at()
    assert store.log.latest()["number"] == 1
    bad = store.stage(items(spark, "bc"), "gold.y", [], expected=7)
    with pytest.raises(Conflict):
        store.publish(store.stage(items(spark, "bc"), "gold.x", []), bad)
    assert store.read("gold.x").count() == 1
    store.publish(store.stage(items(spark, "bc"), "gold.x", []), store.stage(items(spark, "bc"), "gold.y", []))
    assert (store.read("gold.x").count(), view.read("gold.x").count(), view.read("gold.y").count()) == (2, 1, 1)


def test_vacuum_keeps_what_is_named_staged_or_waiting(spark, tmp_path, rows):
    store = Store(spark, str(tmp_path), buckets=1)
    for k in range(4):
        put(store, items(spark, ["a", f"n{k}"], float(k), f"2024-01-0{k + 1}"))
    store.compact(TABLE, everything=True)
    store.put_batch(items(spark, "z"), "bronze.x", "late", arrived="2024-01-01")
    staged = store.stage_run(items(spark, "q"), TABLE, KEYS, LATEST, ["load_ts"])
    before = rows(store.read(TABLE))
    assert store.vacuum(keep=2) == 4
    assert rows(store.read(TABLE)) == before and len(store.log.numbers()) == 2
    store.publish(staged)
    assert store.read(TABLE).count() == len(before) + 1
    assert len(store.arrivals("bronze.x")) == 1
    assert json.loads(store.log.files.read(store.log._path(store.log.numbers()[0])))["number"] == store.log.numbers()[0]
