"""Layout along the curve, reads that skip files, packing and retention."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from stocktide.sources import clustered
from stocktide.sources.clustered import ClusteredTable, z_ordered
from stocktide.sources.commits import Conflict
from stocktide.sources.store import Store

DAY = dt.date(2024, 1, 1)


def grid(spark, n=4096):
    return spark.range(n).select(
        (F.expr("id div 64") * 37 % 64).alias("x"), F.concat(F.lit("item_common_"), F.lpad((F.col("id") % 64).cast("string"), 3, "0")).alias("name"),
        F.date_add(F.lit(DAY), (F.col("id") % 365).cast("int")).alias("day"), "id")


def table(spark, tmp_path, columns):
    return ClusteredTable(Store(spark, str(tmp_path)), "silver.grid", columns)


def test_two_column_filters_skip_most_files(spark, tmp_path, rows):
    t = table(spark, tmp_path, ["x", "name"])
    t.append(grid(spark), 32)
    assert len(t.files()) > 20 and sum(f["rows"] for f in t.files()) == 4096
    ranges = {"x": (10, 17), "name": ("item_common_020", "item_common_027")}
    opened = t.matching(ranges)
    want = grid(spark).where("x between 10 and 17 and name between 'item_common_020' and 'item_common_027'")
    assert rows(t.read(ranges)) == rows(want) and want.count() > 0
    assert len(opened) * 4 <= len(t.files())
    for one in ({"x": (None, 3)}, {"name": ("item_common_060", None)}):  # either column alone skips, too
        assert len(t.matching(one)) * 2 <= len(t.files())
    assert t.read({"x": (999, None)}).count() == 0 and rows(t.read()) == rows(grid(spark))


def test_nulls_and_few_values(spark, tmp_path, rows):
    t = table(spark, tmp_path, ["x", "day"])
    odd = grid(spark, 100).withColumn("x", F.when(F.col("id") % 3 == 0, F.col("x"))).withColumn("day", F.lit(None).cast("date"))
    t.append(odd, 4)
    assert rows(t.read()) == rows(odd) and t.read({"day": (DAY, None)}).count() == 0
    assert rows(t.read({"x": (0, 63)})) == rows(odd.where("x is not null"))
    assert z_ordered(odd.limit(0), ["x", "day"]).count() == 0


def test_small_files_are_packed(spark, tmp_path, rows):
    t = table(spark, tmp_path, ["x", "day"])
    for k in range(5):
        t.append(grid(spark).where(F.col("id") % 5 == k), 3)
    large = max(t.files(), key=lambda f: f["size"])
    before = len(t.files())
    assert t.pack(small_bytes=large["size"], partitions=2) > 0
    assert len(t.files()) < before and large["path"] in {f["path"] for f in t.files()} and rows(t.read()) == rows(grid(spark))
    assert t.pack(small_bytes=1) == 0
    assert t.store.vacuum(keep=1) > 0 and rows(t.read()) == rows(grid(spark))


def test_tasks_of_appends_and_packing_grow_with_the_rows(spark, tmp_path, rows, monkeypatch):
    monkeypatch.setattr(clustered, "FILE_ROWS", 512)
    t = table(spark, tmp_path, ["x", "day"])
    for k in range(2):  # the second half lies in one place
        t.append(grid(spark).withColumn("x", F.when(F.lit(k == 0), F.col("x"))).withColumn("day", F.lit(DAY)).where(F.col("id") % 2 == k), 2, 128)
    before = t.files()
    assert len(before) >= 30 and max(f["rows"] for f in before) < 256
    want = rows(t.read())
    assert t.pack(partitions=2) == len(before)  # two files of 2048 rows each before
    assert 8 <= len(t.files()) < len(before) and max(f["rows"] for f in t.files()) < 1024 and rows(t.read()) == want


def test_packing_gives_way_to_another_rewrite(spark, tmp_path, monkeypatch):
    t = table(spark, tmp_path, ["x", "day"])
    for k in range(2):
        t.append(grid(spark, 200).where(F.col("id") % 2 == k), 2)
    write = t._write

    def interrupted(df, partitions):
        monkeypatch.setattr(t, "_write", write)
        t.expire(DAY + dt.timedelta(days=100), "day")
        return write(df, partitions)

    monkeypatch.setattr(t, "_write", interrupted)
    with pytest.raises(Conflict):
        t.pack()
    assert t.read().count() == grid(spark, 200).where(F.col("day") >= F.lit(DAY + dt.timedelta(days=100))).count()


def test_retention_drops_and_rewrites_only_what_it_must(spark, tmp_path, rows):
    t = table(spark, tmp_path, ["day", "x"])
    data = grid(spark).withColumn("day", F.when(F.col("id") % 97 != 0, F.col("day")))
    for k in range(4):  # a quarter of a year each
        t.append(data.where(f"day between date_add(date'2024-01-01', {k * 92}) and date_add(date'2024-01-01', {k * 92 + 91})"), 3)
    t.append(data.where("day is null"), 1)
    files, cut = {f["path"]: f for f in t.files()}, DAY + dt.timedelta(days=120)
    done = t.expire(cut, "day")
    after = {f["path"] for f in t.files()}
    assert rows(t.read()) == rows(data.where(F.col("day").isNull() | (F.col("day") >= F.lit(cut))))
    assert done["dropped"] >= 3 and done["rewritten"] >= 1 and done["untouched"] >= 6
    assert {p for p, f in files.items() if f["ranges"]["day"][0] is None or f["ranges"]["day"][0] >= cut.isoformat()} <= after
    assert t.expire(cut, "day") == {"dropped": 0, "rewritten": 0, "untouched": len(after)}
    # the rows before are still in the version before, until it is vacuumed
    assert sum(f["rows"] for f in t.store._state("silver.grid", 5)["files"]) == 4096
    assert t.store.vacuum(keep=1) == done["dropped"] + done["rewritten"]
