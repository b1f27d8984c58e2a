"""What a run writes and shuffles per row."""

import glob

from stocktide.plans import catalog
from stocktide.sources.store import Store

SF = "/root/testdata/sf0.001"


def test_a_load_is_written_by_the_tasks_that_read_it(spark, tmp_path):
    store = Store(spark, f"{tmp_path}/lake")
    store.put_batch(spark.range(0, 3000, 1, 3), "bronze.x", "one")
    assert len(glob.glob(f"{tmp_path}/lake/bronze/x/_batch=one/part-*")) == 3  # one before: all rows were shuffled for it
    assert store.read_appended("bronze.x").count() == 3000


def test_deliveries_are_written_once_and_compressed(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    before = set(glob.glob(f"{root}/inventory-*"))
    catalog.QUERIES["run_silver_inventory"](spark, SF).count()
    (made,) = set(glob.glob(f"{root}/inventory-*")) - before
    files = glob.glob(f"{made}/delivery=*/part-*")
    assert {f.rsplit("/", 2)[1] for f in files} == {"delivery=recent", "delivery=old"}
    assert all(f.endswith(".csv.gz") for f in files)
