"""As-of join: every event with the version that holds at its time, by time slices."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

KEY, AT, KIND, SLICE, SEEN, ROW = (f"__asof_{n}" for n in ("key", "at", "kind", "slice", "seen", "row"))


def as_of_join(events: DataFrame, versions: DataFrame, key: str, time: str, version_key: str, start: str, columns: Sequence[str],
               end: str | None = None, slice_unit: str = "month") -> DataFrame:
    """Each event with the ``columns`` of the latest version of its key that started at or before its time.

    Events and versions are one table, dealt to (key, time slice) and sorted there, so an event meets the versions of its own
    slice only and no event meets all versions of its key. What is in force when a slice begins is carried into it: per key and
    slice one row, the last version that started in it, and over those the last one before. A key with very many events is
    spread over its slices; ``slice_unit`` (of ``date_trunc``) says how finely.

    Events without key, time or version keep nulls; with ``end``, a version that ended at or before the event doesn't hold.
    Of versions of one key that start at one instant the greatest by ``end`` and ``columns`` holds. Repeated events give a row each;
    columns of ``events`` that are named like one of ``columns`` raise an error.
    """
    clash = sorted(set(events.columns) & set(columns))
    if clash:
        raise ValueError(f"columns of both sides: {', '.join(clash)}")
    carried = [F.col(start).alias("__start"), *([F.col(end).alias("__end")] if end else []), *(F.col(c).alias(c) for c in columns)]
    begun = versions.where(F.col(version_key).isNotNull() & F.col(start).isNotNull()).select(
        F.col(version_key).alias(KEY), F.col(start).alias(AT), F.struct(*carried).alias(SEEN)).withColumn(SLICE, F.date_trunc(slice_unit, AT))
    timed = events.withColumns({KEY: F.col(key), AT: F.col(time)})
    placed = F.col(KEY).isNotNull() & F.col(AT).isNotNull()
    happened = timed.where(placed).withColumn(SLICE, F.date_trunc(slice_unit, AT))

    # one row per key and slice: its last version, if one started in it
    last = begun.groupBy(KEY, SLICE).agg(F.max(SEEN).alias(SEEN)).withColumn(KIND, F.lit(0))
    wanted = happened.groupBy(KEY, SLICE).agg(F.lit(None).cast(last.schema[SEEN].dataType).alias(SEEN)).withColumn(KIND, F.lit(1))
    before = Window.partitionBy(KEY).orderBy(SLICE, F.desc(KIND)).rowsBetween(Window.unboundedPreceding, -1)
    opening = last.unionByName(wanted).withColumn(SEEN, F.last(SEEN, ignorenulls=True).over(before)).where(F.col(KIND) == 1).where(
        F.col(SEEN).isNotNull()).select(KEY, SLICE, F.col(SLICE).cast(begun.schema[AT].dataType).alias(AT), F.lit(-1).alias(KIND), SEEN)

    rows = happened.withColumn(KIND, F.lit(1)).withColumn(ROW, F.lit(True))
    rows = rows.unionByName(begun.withColumn(KIND, F.lit(0)), allowMissingColumns=True).unionByName(opening, allowMissingColumns=True)
    so_far = Window.partitionBy(KEY, SLICE).orderBy(AT, KIND, SEEN).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    joined = rows.withColumn(SEEN, F.last(SEEN, ignorenulls=True).over(so_far)).where(ROW)
    if end:
        ended = F.col(f"{SEEN}.__end").isNotNull() & (F.col(f"{SEEN}.__end") <= F.col(AT))
        joined = joined.withColumn(SEEN, F.when(~ended, F.col(SEEN)))
    out = [*(F.col(c) for c in events.columns), *(F.col(f"{SEEN}.{c}").alias(c) for c in columns)]
    kinds = {f.name: f.dataType for f in versions.schema.fields}
    without = timed.where(~placed).select(*events.columns, *(F.lit(None).cast(kinds[c]).alias(c) for c in columns))
    return joined.select(*out).unionByName(without)
