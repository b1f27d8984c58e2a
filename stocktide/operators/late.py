"""Late-arriving data: find the touched keys and merge only those."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stocktide.functions.timeexpr import plus_hours, ts
from stocktide.operators.common import first_per_key

FILTER_BITS = 26  # of the filter that spares rows of untouched keys the way to the joins: 8 MB


def late_rows(bronze: DataFrame, as_of: str, cutoff_hours: int = 24, time: str = "_ingestion_ts") -> DataFrame:
    """Rows that arrived within the cutoff before ``as_of``."""
    return bronze.filter((F.col(time) >= plus_hours(ts(as_of), -cutoff_hours)) & (F.col(time) <= ts(as_of)))


def within(arrivals: Sequence[tuple[int, str, str]], as_of: str, cutoff_hours: int = 24) -> list[tuple[int, str, str]]:
    """Of (commit, batch, instant) those whose instant lies within the cutoff before ``as_of``."""
    end = dt.datetime.fromisoformat(as_of)
    return [a for a in arrivals if end - dt.timedelta(hours=cutoff_hours) <= dt.datetime.fromisoformat(a[2]) <= end]


def touched_keys(bronze: DataFrame, keys: Sequence[str], as_of: str, cutoff_hours: int = 24,
                 time: str = "_ingestion_ts") -> DataFrame:
    """Distinct keys with a late row."""
    return late_rows(bronze, as_of, cutoff_hours, time).select(*keys).distinct()


def _maybe(df: DataFrame, touched: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``df`` with ``_maybe``: false where a row's key is surely not among ``touched``. No row travels for it: the hashes of
    the touched keys, a bit each, go to the tasks as a filter of fixed size."""
    bit = F.pmod(F.xxhash64(*keys), F.lit(1 << FILTER_BITS))
    bits = touched.select(bit.alias("_bit")).groupBy(F.expr("_bit div 32768").alias("_word")).agg(
        F.expr("bitmap_construct_agg(_bit % 32768)").alias("_bits"))
    byte = "substring(_bits, cast(_bit % 32768 div 8 as int) + 1, 1)"
    there = F.expr(f"{byte} <> X'00' and shiftright(cast(conv(hex({byte}), 16, 10) as int), cast(_bit % 8 as int)) & 1 = 1")
    placed = df.withColumn("_bit", bit).withColumn("_word", F.expr("_bit div 32768")).join(F.broadcast(bits), "_word", "left")
    return placed.withColumn("_maybe", F.coalesce(there, F.lit(False))).drop("_word", "_bit", "_bits")


def merge_late(silver: DataFrame, feed: DataFrame, keys: Sequence[str], order: Sequence[Column], as_of: str,
               cutoff_hours: int = 24, time: str = "load_ts") -> DataFrame:
    """Bring the keys touched by late rows up to date from the whole feed; other keys pass through.

    ``feed`` is the conformed input. A correction replaces the row it corrects
    and repeats nothing. Rows that a filter of the touched keys' hashes rules out
    are not shuffled; exact joins follow for the others.
    """
    touched = touched_keys(feed, keys, as_of, cutoff_hours, time)
    on = list(keys)
    held = _maybe(silver, touched, keys)
    near = held.filter("_maybe").drop("_maybe")
    kept = held.filter("not _maybe").drop("_maybe").unionByName(near.join(touched, on, "left_anti"))
    competing = near.join(touched, on, "left_semi").unionByName(
        _maybe(feed, touched, keys).filter("_maybe").drop("_maybe").join(touched, on, "left_semi"), allowMissingColumns=True)
    return kept.unionByName(first_per_key(competing, keys, order), allowMissingColumns=True)
