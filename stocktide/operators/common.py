"""Building blocks used by several operators."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


#: Rows that a step of a run shuffles at a time.
PART_ROWS = 4_000_000


def parts_of(rows: int, most: int) -> int:
    """How many parts so many rows are worked on in, one after another. Every part reads the whole input once."""
    return max(1, min(most, math.ceil(rows / PART_ROWS)))


def in_parts(df: DataFrame, keys: Sequence[str], parts: int) -> list[DataFrame]:
    """All rows, dealt to frames by the hash of their keys, nulls included: rows of one key are in one frame."""
    if parts == 1:
        return [df]
    part = F.pmod(F.xxhash64(*keys), F.lit(parts))
    return [df.filter(part == i) for i in range(parts)]


def require_columns(df: DataFrame, names: Sequence[str], what: str) -> DataFrame:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"{what}: required columns missing: {', '.join(missing)}")
    return df


def with_missing(df: DataFrame, **defaults: Column) -> DataFrame:
    """Add the named columns where the frame lacks them."""
    absent = {name: value for name, value in defaults.items() if name not in df.columns}
    return df.withColumns(absent) if absent else df


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key, the first in ``order``; remaining ties are settled by all other columns.

    The ``row_number = 1`` form lets Spark limit every group to one row before
    the shuffle (window group limit), so a key holding much of the table does
    not travel to one task. The key's hash leads the partition columns: it
    changes no group, and sorts by a number instead of by long equal key prefixes.
    """
    rest = [F.asc_nulls_last(c) for c in sorted(df.columns) if c not in keys]
    hashed = df.withColumn("_kh", F.xxhash64(*keys))
    w = Window.partitionBy("_kh", *keys).orderBy(*order, *rest)
    return hashed.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn", "_kh")


def merge_latest(
    existing: DataFrame, incoming: DataFrame, keys: Sequence[str], order: Sequence[Column]
) -> DataFrame:
    """Latest row per key over both frames, of which ``existing`` holds one row per key.

    Both are read once and travel once, to the choice of the latest row. Existing
    rows without a key compete with none and all stay.
    """
    loose = reduce(or_, (F.col(k).isNull() for k in keys))
    held = existing.withColumn("_loose", F.when(loose, F.monotonically_increasing_id()))
    both = held.unionByName(incoming, allowMissingColumns=True)
    return first_per_key(both, [*keys, "_loose"], order).drop("_loose")
