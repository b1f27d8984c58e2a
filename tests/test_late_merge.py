"""Late merges: which rows travel, and the whole result against a plain loop."""

from pyspark.sql import functions as F

from stocktide.operators import late
from stocktide.operators.common import merge_latest

SCHEMA = "k string, j int, v int, load_ts timestamp_ntz"
AS_OF = "2024-03-10 00:00:00"


def feed(spark, days):
    """Rows of 400 keys, some null, on the given days of March; every 50th key has a row of the last day."""
    return spark.range(400, numPartitions=4).withColumn("day", F.explode(F.array(*map(F.lit, days)))).where("day < 9 or id % 50 = 0").selectExpr(
        "if(id % 90 = 89, null, concat('key', id)) as k", "cast(id % 3 as int) as j", "cast(id * 7 + day as int) as v",
        "make_timestamp_ntz(2024, 3, day, 12, 0, 0) as load_ts")


def test_rows_of_untouched_keys_need_no_join(spark):
    rows, keys = feed(spark, [1, 9]), ["k", "j"]
    touched = late.touched_keys(rows, keys, AS_OF, 24, "load_ts")
    sure = {tuple(r) for r in late._maybe(rows, touched, keys).where("not _maybe").select(*keys).collect()}
    assert not sure & {tuple(r) for r in touched.collect()} and len(sure) > 370 and touched.count() == 8  # all of them were joined before


def test_late_rows_are_merged_like_in_a_loop(spark, rows):
    keys, order = ["k", "j"], [F.col("load_ts").desc_nulls_last()]
    silver, everything = feed(spark, [2]).withColumn("v", F.col("v") + 1000), feed(spark, [1, 2, 9])
    got = rows(late.merge_late(silver, everything, keys, order, AS_OF, 24).select("k", "j", "v", "load_ts"))
    held, new = [tuple(r) for r in silver.collect()], [tuple(r) for r in everything.collect()]
    touched = {r[:2] for r in new if r[0] is not None and r[3].day == 9}
    want = [r for r in held if r[:2] not in touched]
    for key in touched:
        want.append(max((r for r in held + new if r[:2] == key), key=lambda r: (r[3], -r[2])))
    assert touched and got == sorted(want, key=repr)


def test_an_upsert_reads_each_side_once(spark, rows):
    keys, order = ["k", "j"], [F.col("load_ts").desc_nulls_last()]
    held, new = feed(spark, [2]).withColumn("v", F.col("v") + 1000), feed(spark, [1, 9]).where("v % 4 = 0")
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    held, new = (df.select("k", "j", "v", "load_ts").mapInArrow(counted, SCHEMA) for df in (held, new))
    got = rows(merge_latest(held, new, keys, order))
    assert seen.value == 400 + new.count()  # existing rows were read twice, and incoming ones too, before
    old, fresh = [tuple(r) for r in held.collect()], [tuple(r) for r in new.collect()]
    want = [r for r in old if r[0] is None]
    named = [r for r in old if r[0] is not None] + fresh
    for key in {r[:2] for r in named}:
        want.append(max((r for r in named if r[:2] == key), key=lambda r: (r[3], -r[2])))
    assert got == sorted(want, key=repr)
