"""Tables laid out along a space-filling curve, with the value ranges of every file in the commit log."""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from stocktide.sources.commits import Conflict
from stocktide.sources.store import Staged, Store

#: Rows that the borders of the curve's cells are estimated from; they decide on the layout only, never on results.
BORDER_ROWS = 10_000
#: Rows that one task sorts into a file, about: a larger table takes more tasks and files, not larger ones.
FILE_ROWS = 1 << 20


def _not_above(column: str):
    return lambda border: border <= F.col(column)


def curve(df: DataFrame, columns: Sequence[str], bits: int = 6) -> Column:
    """Place of a row on the Z curve through ``columns`` (of any ordered type): the bits of their ranks, interleaved.

    A rank counts how many of 2^bits - 1 borders don't exceed the value; borders are quantiles of a bounded random sample, so
    every column is cut into cells of like many rows. Nulls come first.
    """
    sample = df.select(*columns).orderBy(F.rand(7)).limit(BORDER_ROWS).collect()
    place = F.lit(0).cast("bigint")
    for k, column in enumerate(columns):
        values = sorted(r[column] for r in sample if r[column] is not None)
        borders = sorted({values[len(values) * i // (1 << bits)] for i in range(1, 1 << bits)}) if values else []
        cells = F.array(*map(F.lit, borders)) if borders else None
        rank = F.size(F.filter(cells, _not_above(column))) if borders else F.lit(0)
        rank = F.when(F.col(column).isNull(), 0).otherwise(rank).cast("bigint")
        for b in range(bits):
            place = place.bitwiseOR(F.shiftleft(F.shiftright(rank, b).bitwiseAND(F.lit(1).cast("bigint")), b * len(columns) + k))
    return place


def z_ordered(df: DataFrame, columns: Sequence[str], partitions: int | None = None, bits: int = 6,
              file_rows: int | None = None) -> DataFrame:
    """Range-partitioned and sorted along the curve: a file holds a narrow range of every column, not of the first only.

    ``partitions`` (None: as adaptive execution sizes them) are made, or as many more as it takes for ``file_rows`` rows
    each (None: ``FILE_ROWS``); rows are counted as borders are sampled. Rows of one place are told apart by ten bits of
    a hash of all columns, so a common place is spread, too.
    """
    seen = Observation()
    placed = df.withColumns({"_z": curve(df.observe(seen, F.count(F.lit(1)).alias("rows")), columns, bits),
                             "_h": F.xxhash64(*df.columns).bitwiseAND(F.lit(1023))})
    needed = -(-seen.get["rows"] // (file_rows or FILE_ROWS))
    if partitions or needed > int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")):
        partitions = max(partitions or 1, needed)
    ranged = placed.repartitionByRange(partitions, "_z", "_h") if partitions else placed.repartitionByRange("_z", "_h")
    return ranged.drop("_h").sortWithinPartitions("_z", *columns).drop("_z")


def _plain(value: Any) -> Any:
    """A value that JSON holds and that orders like the original among its kind."""
    if isinstance(value, dt.datetime):
        return value.isoformat(timespec="microseconds")
    return value.isoformat() if isinstance(value, dt.date) else value


@dataclass
class ClusteredTable:
    """A table of a store whose files are named by its commits, with rows, size and the range of ``columns`` of each.

    A read with ranges opens the files that can hold such rows. Appends add files; ``pack`` rewrites small ones together;
    ``expire`` drops files by their recorded times. Files that no commit names any more go with ``Store.vacuum``.
    """

    store: Store
    table: str
    columns: Sequence[str]

    def _state(self) -> dict | None:
        return self.store._state(self.table)

    def files(self) -> list[dict]:
        state = self._state()
        return state["files"] if state else []

    def _index(self, folder: str, schema: StructType) -> list[dict]:
        """One entry per file written; as many as there are files."""
        written = self.store.spark.read.schema(schema).parquet(f"{self.store.path(self.table)}/data/{folder}")
        rows = written.groupBy(F.col("_metadata.file_name").alias("_file"), F.col("_metadata.file_size").alias("_size")).agg(
            F.count("*").alias("_rows"),
            *(agg for c in self.columns for agg in (F.min(c).alias(f"min_{c}"), F.max(c).alias(f"max_{c}"), F.count_if(F.col(c).isNull()).alias(f"nulls_{c}"))))
        return [{"path": f"{folder}/{r['_file']}", "rows": r["_rows"], "size": r["_size"],
                 "ranges": {c: [_plain(r[f"min_{c}"]), _plain(r[f"max_{c}"]), r[f"nulls_{c}"]] for c in self.columns}} for r in rows.collect()]

    def _write(self, df: DataFrame, partitions: int | None, file_rows: int | None = None) -> list[dict]:
        folder = f"v={uuid.uuid4().hex}"
        z_ordered(df, self.columns, partitions, file_rows=file_rows).write.parquet(f"{self.store.path(self.table)}/data/{folder}")
        return self._index(folder, df.schema)

    def _commit(self, schema: StructType, added: list[dict], removed: Sequence[str] = ()) -> None:
        gone = set(removed)

        def change(state):
            held = state["files"] if state else []
            if not gone <= {f["path"] for f in held}:
                raise Conflict(f"{self.table}: files were rewritten by another writer")
            return {"kind": "files", "files": [*(f for f in held if f["path"] not in gone), *added], "schema": json.dumps(schema.jsonValue())}

        self.store.publish(Staged(self.table, change, ""))

    def append(self, df: DataFrame, partitions: int | None = None, file_rows: int | None = None) -> None:
        """Adds files: ``partitions``, or more where these would hold over ``file_rows`` (None: ``FILE_ROWS``) rows each."""
        self._commit(df.schema, self._write(df, partitions, file_rows))

    def _open(self, files: list[dict]) -> DataFrame:
        state = self._state()
        if state is None:
            return self.store.empty(self.table)
        schema = StructType.fromJson(json.loads(state["schema"]))
        if not files:
            return self.store.spark.createDataFrame([], schema)
        return self.store.spark.read.schema(schema).parquet(*(f"{self.store.path(self.table)}/data/{f['path']}" for f in files))

    def matching(self, ranges: Mapping[str, tuple[Any, Any]]) -> list[dict]:
        """Files that may hold rows whose columns all lie within [low, high] (None: open)."""
        def may(file: dict) -> bool:
            for column, (low, high) in ranges.items():
                least, most, _ = file["ranges"][column]
                if least is None or (low is not None and most < _plain(low)) or (high is not None and least > _plain(high)):
                    return False
            return True

        return [f for f in self.files() if may(f)]

    def read(self, ranges: Mapping[str, tuple[Any, Any]] | None = None) -> DataFrame:
        """All rows, or those whose columns lie within ranges, from the files that can hold them."""
        if not ranges:
            return self._open(self.files())
        rows = self._open(self.matching(ranges))
        for column, (low, high) in ranges.items():
            if low is not None:
                rows = rows.where(F.col(column) >= F.lit(low))
            if high is not None:
                rows = rows.where(F.col(column) <= F.lit(high))
            rows = rows.where(F.col(column).isNotNull())
        return rows

    def pack(self, small_bytes: int = 64 << 20, partitions: int | None = None) -> int:
        """Rewrite the files below ``small_bytes`` together, along the curve; large ones stay, and those that hold half of what
        a task sorts (``FILE_ROWS``). Returns how many were rewritten. There are ``partitions`` new files, more where these
        would hold over ``FILE_ROWS`` rows each; without ``partitions`` adaptive execution sizes them."""
        small = [f for f in self.files() if f["size"] < small_bytes and 2 * f["rows"] < FILE_ROWS]
        if len(small) < 2:
            return 0
        rows = self._open(small)
        self._commit(rows.schema, self._write(rows, partitions), [f["path"] for f in small])
        return len(small)

    def expire(self, before: Any, time: str) -> dict[str, int]:
        """Drop rows whose ``time`` lies before an instant; rows without a time stay.

        Files that ended before it are dropped without being read, those that begin at or after it aren't touched, and only
        those that hold both are rewritten. What is dropped stays readable in earlier versions until they are vacuumed.
        """
        border, gone, mixed = _plain(before), [], []
        for file in self.files():
            least, most, nulls = file["ranges"][time]
            if least is not None and least < border:
                (gone if most < border and not nulls else mixed).append(file)
        added: list[dict] = []
        if mixed:
            rows = self._open(mixed).where(F.col(time).isNull() | (F.col(time) >= F.lit(before)))
            added = self._write(rows, None)
        if gone or mixed:
            schema = StructType.fromJson(json.loads(self._state()["schema"]))
            self._commit(schema, [f for f in added if f["rows"]], [f["path"] for f in [*gone, *mixed]])
        return {"dropped": len(gone), "rewritten": len(mixed), "untouched": len(self.files()) - len([f for f in added if f["rows"]])}
