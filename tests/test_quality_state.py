"""Quality of a growing table: batch by batch it is what it is over the whole."""

import pytest
from pyspark.sql import functions as F

from stocktide.operators import quality
from stocktide.plans.quality_state import QualityState
from stocktide.sources.store import Store

SCHEMA = "shipment_id string, status string, weight double, planned_departure_ts timestamp_ntz, planned_arrival_ts timestamp_ntz"


def feed(spark, low, high):
    """Rows of which many repeat within and across ranges."""
    return spark.range(low, high).selectExpr(
        "if(id % 11 = 0, null, concat('s', id % 40)) shipment_id", "if(id % 7 = 0, 'lost', 'planned') status",
        "case when id % 5 = 0 then -1.0d when id % 9 = 0 then -0.0d when id % 9 = 1 then null else 0.0d end weight",
        "if(id % 13 = 0, timestamp_ntz'2024-01-02', null) planned_departure_ts", "timestamp_ntz'2024-01-01' planned_arrival_ts")


def whole(spark, *ranges):
    rows = feed(spark, *ranges[0])
    for r in ranges[1:]:
        rows = rows.union(feed(spark, *r))
    return rows


def test_batches_add_up_to_the_whole(spark, tmp_path):
    state, ranges = QualityState(Store(spark, str(tmp_path), buckets=4), "shipment"), [(0, 300), (200, 500), (0, 50), (1000, 1001)]
    for k, r in enumerate(ranges, 1):
        assert state.add(feed(spark, *r), k)
        assert state.score().first() == quality.quality_score(whole(spark, *ranges[:k]), "shipment").first()
        state.store.compact(state.name)
    assert not state.add(feed(spark, 0, 300), 2)  # counted already
    assert state.score().first() == quality.quality_score(whole(spark, *ranges), "shipment").first()
    assert state.store.read(state.name).count() == whole(spark, *ranges).distinct().count()
    written = [sum(r["rows"] for rs in state.store._state(state.name)["buckets"].values() for r in rs)]
    state.add(feed(spark, 0, 300), 5)  # nothing new: no digest is written
    assert [sum(r["rows"] for rs in state.store._state(state.name)["buckets"].values() for r in rs)] == written


def test_two_writers_count_no_row_as_distinct_twice(spark, tmp_path, monkeypatch):
    store = Store(spark, str(tmp_path), buckets=1)
    state, other = QualityState(store, "shipment"), QualityState(Store(spark, str(tmp_path), buckets=1), "shipment")
    state.add(feed(spark, 0, 20), 1)
    publish = store.publish

    def interrupted(*staged, **rest):
        monkeypatch.setattr(store, "publish", publish)
        other.add(feed(spark, 20, 60), 2)
        return publish(*staged, **rest)

    monkeypatch.setattr(store, "publish", interrupted)
    assert state.add(feed(spark, 40, 80), 3)
    assert state.score().first() == quality.quality_score(whole(spark, (0, 20), (20, 60), (40, 80)), "shipment").first()


def test_rows_are_told_apart_by_digest(spark):
    rows = spark.createDataFrame([(None, "a"), ("a", None), ("a", "a"), ("", None), (None, None), (None, "a")], "x string, y string")
    assert quality.row_groups(rows).count() == 5
    assert quality.duplicate_rows(rows).first().duplicate_count == 1
    assert quality.row_groups(spark.createDataFrame([(0.0,), (-0.0,)], "x double")).count() == 1


def test_many_columns_and_an_empty_table(spark, tmp_path):
    wide = spark.range(3).select(*[F.when(F.col("id") != i % 3, F.col("id")).alias(f"c{i}") for i in range(130)])
    row = quality.quality_score(wide, "x").first()
    assert row.total_records == 3 and row.null_penalty == pytest.approx(0.3)
    assert quality.quality_score(wide.limit(0), "x").first().quality_score == 0.0
    with pytest.raises(ValueError, match="no batch"):
        QualityState(Store(spark, str(tmp_path)), "x").score()
