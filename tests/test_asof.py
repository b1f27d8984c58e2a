"""As-of join against a search through all versions."""

import datetime as dt
import random

import pytest

from stocktide.operators.asof import as_of_join

DAY = dt.datetime(2024, 1, 1)
EVENTS, VERSIONS = "e long, k string, at timestamp_ntz, extra string", "vk string, begins timestamp_ntz, ends timestamp_ntz, value string"


def brute(events, versions, ends):
    out = []
    for e, k, at, extra in events:
        held = [(b, end, v) for vk, b, end, v in versions if vk is not None and vk == k and b is not None and at is not None and b <= at]
        best = max(held, key=lambda x: (x[0], ends and x[1] is not None, (ends and x[1]) or DAY, x[2] is not None, x[2] or "")) if held else (None, None, None)
        if ends and best[1] is not None and best[1] <= at:
            best = (None, None, None)
        out.append((e, k, at, extra, best[0], best[2]))
    return sorted(out, key=repr)


@pytest.mark.parametrize("unit", ["hour", "month", "year"])
@pytest.mark.parametrize("ends", [True, False])
def test_as_of_join_equals_brute_force_under_a_hot_key(spark, unit, ends):
    rng = random.Random(unit + str(ends))
    when = lambda: rng.choice([None, DAY, DAY + dt.timedelta(hours=rng.randrange(4000)), DAY + dt.timedelta(hours=rng.randrange(4000))])
    keys = lambda: "HOT" if rng.random() < 0.5 else rng.choice([None, "a", "b", "none"])
    versions = [(rng.choice(["HOT", "HOT", "a", "b", None]), when(), when(), rng.choice([None, "x", "y", "z"])) for _ in range(60)]
    versions += versions[:3]
    events = [(i, keys(), when(), "same") for i in range(300)]
    events += events[:5] + [(999, "HOT", v[1], "at the very start") for v in versions[:5]]
    got = as_of_join(spark.createDataFrame(events, EVENTS), spark.createDataFrame(versions, VERSIONS), "k", "at", "vk", "begins",
                     ["begins", "value"], "ends" if ends else None, unit)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute(events, versions, ends)


def test_plan_joins_nothing_and_deals_by_slice(spark):
    events, versions = spark.createDataFrame([(1, "a", DAY, "x")], EVENTS), spark.createDataFrame([("a", DAY, None, "v")], VERSIONS)
    plan = as_of_join(events, versions, "k", "at", "vk", "begins", ["value"])._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "hashpartitioning(__asof_key" in plan


def test_empty_sides_and_clashing_columns(spark):
    events, versions = spark.createDataFrame([(1, "a", DAY, "x")], EVENTS), spark.createDataFrame([("a", DAY, None, "v")], VERSIONS)
    assert [r.value for r in as_of_join(events, versions.limit(0), "k", "at", "vk", "begins", ["value"]).collect()] == [None]
    assert as_of_join(events.limit(0), versions, "k", "at", "vk", "begins", ["value"]).count() == 0
    with pytest.raises(ValueError, match="both sides"):
        as_of_join(events, versions.withColumnRenamed("value", "extra"), "k", "at", "vk", "begins", ["extra"])
