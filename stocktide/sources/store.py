"""Tables as parquet directories under one commit log.

Append tables are one directory; a load that may be repeated is a batch in a directory of its own, overwritten when it comes
again. Replaced tables are written whole, in a folder of unique name. Keyed tables are runs: a batch writes its own rows only,
dealt to buckets by the key's hash, and a read takes for every key what its runs say; compaction merges the newest runs of a
bucket once there are several of a size, and splits a bucket that has grown. Nothing written is in force before a commit names
it, and one commit may put several tables in force, so readers never see a half-written or vanishing table or a mix of tables,
and a lost executor or driver leaves what was in force.
"""

from __future__ import annotations

import copy
import json
import math
import uuid
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from stocktide import schemas
from stocktide.session import release
from stocktide.sources.commits import CommitLog, Conflict

BATCH, BUCKET = "_batch", "_bucket"
#: Hash bits that bucket numbers are taken from.
BITS = 24
LATEST, REPLACE = "latest", "replace"


@dataclass
class Staged:
    """What was written for a table and isn't in force yet."""

    table: str
    change: Callable[[dict | None], dict]
    folder: str
    buckets: dict[str, int] = field(default_factory=dict)  # rows per bucket written
    number: int = 0

    def __int__(self) -> int:
        return self.number


def bucket_name(depth: int, value: int) -> str:
    return f"{depth}-{value}"


class Store:
    """``buckets``: of keyed tables that this store writes first. ``split_rows``: a bucket whose merged rows are more is split;
    about what a task should hold. ``fanout``: so many runs of a size are merged into one."""

    def __init__(self, spark: SparkSession, root: str, buckets: int = 16, split_rows: int = 4_000_000, fanout: int = 4):
        self.spark, self.root = spark, root.rstrip("/")
        self.depth = max(0, math.ceil(math.log2(buckets)))
        self.split_rows, self.fanout = split_rows, fanout
        self.log = CommitLog(spark, self.root)
        self._pinned: dict | None = None

    # --- states ---

    def at(self, number: int | None = None) -> Store:
        """This store as one commit left it (by default the latest), whatever is committed later."""
        pinned = copy.copy(self)
        pinned._pinned = self.log.latest() if number is None else self.log.at(number)
        return pinned

    @property
    def commit(self) -> dict:
        return self._pinned or self.log.latest()

    def _state(self, table: str, version: int | None = None) -> dict | None:
        commit = self.commit
        if version is None:
            return self.log.state(commit, table)
        for number in reversed(self.log.numbers()):
            state = self.log.state(self.log.at(number), table)
            if state and state["version"] == version:
                return state
        raise ValueError(f"{table} has no version {version}")

    def version(self, table: str) -> int:
        """Number of the version in force, 0 when the table was never written."""
        state = self._state(table)
        return state["version"] if state else 0

    def rows(self, table: str) -> int:
        """Rows in force; of keyed tables those of all runs, some of which a read leaves out."""
        state = self._state(table)
        if state and state["kind"] == "runs":
            return sum(r["rows"] for runs in state["buckets"].values() for r in runs)
        return self.read(table).count()

    def path(self, table: str) -> str:
        return f"{self.root}/{table.replace('.', '/')}"

    def empty(self, table: str) -> DataFrame:
        return self.spark.createDataFrame([], schemas.TABLES[table])

    def _partitions(self, table: str, partition_by: Sequence[str] | None) -> list[str]:
        return list(schemas.PARTITIONS.get(table, []) if partition_by is None else partition_by)

    def _balanced(self, df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
        """Few files per partition value; values holding much of the data are split over several tasks."""
        return df.hint("rebalance", *[F.col(c) for c in partition_by]) if partition_by else df.hint("rebalance")

    def publish(self, *staged: Staged, events: list[list] = ()) -> dict:
        """Put staged tables in force, all by one commit."""
        return self.log.commit({s.table: s.change for s in staged}, events)

    # --- append tables ---

    def _with_schema(self, schema: StructType, table: str) -> Callable[[dict | None], dict]:
        """Records the columns of an append table, so that a read needs no file to know them."""

        def change(state):
            known = StructType.fromJson(json.loads(state["schema"])) if state else StructType()
            held = {f.name: f.dataType for f in known.fields}
            clash = [f.name for f in schema.fields if held.get(f.name, f.dataType) != f.dataType]
            if clash:
                raise ValueError(f"{table}: other types than before: {', '.join(clash)}")
            new = [StructField(f.name, f.dataType) for f in schema.fields if f.name not in held]
            return state if state and not new else {"kind": "appended", "schema": json.dumps(StructType(known.fields + new).jsonValue())}

        return change

    def append(self, df: DataFrame, table: str, partition_by: Sequence[str] | None = None) -> None:
        parts = self._partitions(table, partition_by)
        self._balanced(df, parts).write.mode("append").partitionBy(*parts).parquet(self.path(table))
        self.log.commit({table: self._with_schema(df.schema, table)})

    def put_batch(self, df: DataFrame, table: str, batch: str, arrived: str | None = None, alone: bool = False) -> None:
        """Write one load; the same load again takes the place of its rows. ``arrived``: the instant of a load that later steps
        are to find among the arrivals. ``alone``: a load of columns of its own, which is only read by itself. A load is written
        by the tasks that read it, in as many files; it isn't shuffled for that."""
        df.write.mode("overwrite").option("compression", "zstd").parquet(f"{self.path(table)}/{BATCH}={batch}")
        if alone:
            return
        with_batch = StructType([*df.schema.fields, StructField(BATCH, StringType())])
        self.log.commit({table: self._with_schema(with_batch, table)}, [[table, batch, arrived]] if arrived else [])

    def through(self, table: str) -> int:
        """Commit up to which a keyed table has worked in what arrived."""
        state = self._state(table)
        return state.get("through", 0) if state else 0

    def arrivals(self, table: str, after: int = 0) -> list[tuple[int, str, str]]:
        """(commit, batch, instant) of the loads that came after a commit, oldest first; a repeated load counts when last
        written."""
        found = {}
        for number in self.log.numbers():
            if after < number <= self.commit["number"]:
                for name, batch, instant in self.log.at(number)["events"]:
                    if name == table:
                        found[batch] = (number, batch, instant)
        return sorted(found.values())

    def read_appended(self, table: str, batches: Iterable[str] | None = None) -> DataFrame:
        """All appended rows, or those of some batches; a column that a file lacks is null. A table never written is empty."""
        state = self._state(table)
        if state is None:
            return self.empty(table)
        schema = StructType.fromJson(json.loads(state["schema"]))
        reader = self.spark.read.schema(schema)
        try:
            if batches is None:
                return reader.parquet(self.path(table))
            paths = [f"{self.path(table)}/{BATCH}={b}" for b in batches]
            return reader.option("basePath", self.path(table)).parquet(*paths) if paths else reader.parquet(self.path(table)).limit(0)
        except AnalysisException as error:
            if error.getCondition() == "PATH_NOT_FOUND" and batches is None:  # only empty appends so far
                return self.spark.createDataFrame([], schema)
            raise

    # --- replaced tables ---

    def stage(self, df: DataFrame | Sequence[DataFrame], table: str, partition_by: Sequence[str] | None = None, keep_layout: bool = False,
              expected: int | None = None) -> Staged:
        """Write a new version without switching to it, so it can be checked first. Several frames are written one after another;
        what one has shuffled is let go before the next. Without folders, rows are written by the tasks that have made them.
        ``keep_layout`` leaves the rows in the order and files that the frame gives them. ``expected``: the version it was made
        from; another one is a conflict."""
        parts = self._partitions(table, partition_by)
        folder = f"v={uuid.uuid4().hex}"
        frames = [df] if isinstance(df, DataFrame) else df
        for frame in frames:
            placed = frame if keep_layout or not parts else self._balanced(frame, parts)
            placed.write.mode("append").option("compression", "zstd").partitionBy(*parts).parquet(f"{self.path(table)}/data/{folder}")
            if len(frames) > 1:
                release(self.spark)

        def change(state):
            if expected is not None and (state["version"] if state else 0) != expected:
                raise Conflict(f"{table}: version {expected} is no longer in force")
            return {"kind": "whole", "folder": folder}

        return Staged(table, change, folder, number=self.version(table) + 1)

    def replace(self, df: DataFrame, table: str, partition_by: Sequence[str] | None = None, keep_layout: bool = False) -> int:
        """Write a new version and switch to it. The frame may read the version in force."""
        staged = self.stage(df, table, partition_by, keep_layout)
        self.publish(staged)
        return self.version(table)

    # --- keyed tables ---

    def _directory(self, state: dict | None) -> dict[str, list[dict]]:
        """Runs per bucket. Bucket d-v holds the keys whose lowest d hash bits are v; depths may differ. A table that was written
        whole is the first run of a single bucket."""
        if state is None:
            return {bucket_name(self.depth, v): [] for v in range(1 << self.depth)}
        if state["kind"] == "whole":
            return {bucket_name(0, 0): [{"path": state["folder"], "rows": 0, "tier": 1}]}
        return state["buckets"]

    @staticmethod
    def bucket_of(keys: Sequence[str], buckets: Iterable[str]) -> Column:
        """Name of the bucket of a row, for a directory of any depths."""
        names = list(buckets)
        depth = max(int(n.split("-")[0]) for n in names)
        slots = [""] * (1 << depth)
        for name in names:
            d, v = map(int, name.split("-"))
            slots[v :: 1 << d] = [name] * (1 << (depth - d))
        slot = F.pmod(F.xxhash64(*keys), F.lit(1 << BITS)).bitwiseAND(F.lit((1 << depth) - 1)).cast("int")
        return F.element_at(F.split(F.lit(",".join(slots)), ","), slot + 1)

    def touched(self, table: str, keys: Sequence[str], rows: DataFrame) -> list[str]:
        """Buckets of some keys; there are never more of them than buckets."""
        names = self._directory(self._state(table))
        return sorted(r[0] for r in rows.select(self.bucket_of(keys, names).alias("b")).distinct().collect())

    def stage_run(self, df: DataFrame, table: str, keys: Sequence[str], merge: str = LATEST, order: Sequence[str] = (),
                  through: tuple[int, int] | None = None) -> Staged:
        """Write rows of a batch as one run per bucket. Other rows are neither read nor written.

        ``merge``: how a read settles a key that several runs hold. ``latest``: its first row by ``order`` (columns, highest
        first), ties by all columns; runs of two writers go on top of each other. ``replace``: the rows of its newest run; made
        from what is in force, so a bucket that another writer changed in between is a conflict. ``through``: (before, after)
        commit up to which arrivals are worked in; another ``before`` in force is a conflict.
        """
        seen = self._directory(self._state(table))
        folder = f"v={uuid.uuid4().hex}"
        path = f"{self.path(table)}/data/{folder}"
        placed = df.withColumn(BUCKET, self.bucket_of(keys, seen))
        self._balanced(placed, [BUCKET]).write.option("compression", "zstd").partitionBy(BUCKET).parquet(path)
        written = self._rows_of(path, df.schema)
        schema = json.dumps(df.schema.jsonValue())

        def change(state):
            held = self._directory(state)
            if through is not None and (state or {}).get("through", 0) != through[0]:
                raise Conflict(f"{table}: its arrivals were worked in by another writer")
            for bucket in written:
                if bucket not in held:
                    raise Conflict(f"{table}: bucket {bucket} was split")
                if merge == REPLACE and held[bucket] != seen[bucket]:
                    raise Conflict(f"{table}: bucket {bucket} was changed by another writer")
            buckets = dict(held)
            for bucket, rows in written.items():
                buckets[bucket] = [*held[bucket], {"path": f"{folder}/{BUCKET}={bucket}", "rows": rows, "tier": 0}]
            return {"kind": "runs", "keys": list(keys), "merge": merge, "order": list(order), "schema": schema, "buckets": buckets,
                    "through": through[1] if through is not None else (state or {}).get("through", 0)}

        return Staged(table, change, folder, written, self.version(table) + 1)

    def _rows_of(self, path: str, schema: StructType) -> dict[str, int]:
        """Rows per bucket folder, from the footers of what was just written."""
        typed = StructType([*schema.fields, StructField(BUCKET, StringType())])
        rows = self.spark.read.schema(typed).parquet(path).groupBy(BUCKET).count().collect()
        return {r[0]: r[1] for r in rows if r[0] is not None}

    def drop_staged(self, staged: Staged) -> None:
        """Delete what was staged and isn't to be put in force."""
        self.log.files.delete(f"{self.path(staged.table)}/data/{staged.folder}")

    def read_staged(self, staged: Staged) -> DataFrame:
        return self.spark.read.parquet(f"{self.path(staged.table)}/data/{staged.folder}").drop(BUCKET)

    def _read_runs(self, table: str, state: dict, buckets: dict[str, list[dict]]) -> DataFrame:
        """Rows of some runs of a keyed table, one state per key. A bucket of a single run is read as it is."""
        schema = StructType.fromJson(json.loads(state["schema"]))
        base, keys = f"{self.path(table)}/data", state["keys"]

        def read(runs):
            return self.spark.read.schema(schema).parquet(*(f"{base}/{r['path']}" for r in runs))

        single = [runs[0] for runs in buckets.values() if len(runs) == 1]
        several = [runs for runs in buckets.values() if len(runs) > 1]
        if not several:
            return read(single) if single else self.spark.createDataFrame([], schema)
        hashed = ["_kh", *keys]
        if state["merge"] == LATEST:
            rest = sorted((c for c in schema.names if c not in keys), key=lambda c: (c == "created_at", c))
            order = [*(F.desc_nulls_last(c) for c in state["order"]), *(F.asc_nulls_last(c) for c in rest)]
            rows = read([r for runs in several for r in runs]).withColumn("_kh", F.xxhash64(*keys))
            merged = rows.withColumn("_rn", F.row_number().over(Window.partitionBy(*hashed).orderBy(*order))).where("_rn = 1").drop("_rn", "_kh")
        else:
            # place of the run within its bucket: all runs of one place are one read, so the plan doesn't grow with buckets
            places = [[runs[i] for runs in several if len(runs) > i] for i in range(max(map(len, several)))]
            rows = read(places[0]).withColumn("_run", F.lit(0))
            for i, runs in enumerate(places[1:], 1):
                rows = rows.union(read(runs).withColumn("_run", F.lit(i)))
            newest = F.max("_run").over(Window.partitionBy(*hashed))
            merged = rows.withColumn("_kh", F.xxhash64(*keys)).withColumn("_newest", newest).where("_run = _newest").drop("_run", "_newest", "_kh")
        return read(single).union(merged) if single else merged

    def read(self, table: str, version: int | Staged | None = None, buckets: Iterable[str] | None = None) -> DataFrame:
        """The version in force, an earlier or a staged one, or some of its buckets. A table never written is empty."""
        if isinstance(version, Staged):
            return self.read_staged(version)
        state = self._state(table, version)
        if state is None:
            return self.empty(table)
        if state["kind"] == "whole":
            return self.spark.read.parquet(f"{self.path(table)}/data/{state['folder']}")
        wanted = None if buckets is None else set(buckets)
        return self._read_runs(table, state, {b: runs for b, runs in state["buckets"].items() if runs and (wanted is None or b in wanted)})

    # --- compaction ---

    def _due(self, runs: list[dict], everything: bool) -> int:
        """How many of a bucket's newest runs are to be merged: as soon as ``fanout`` of one tier stand at the end."""
        if everything:
            return len(runs) if len(runs) > 1 else 0
        due = 0
        for tier in range(1 + max((r["tier"] for r in runs), default=0)):
            newest = 0
            while newest < len(runs) and runs[-1 - newest]["tier"] <= tier:
                newest += 1
            # what is merged below counts as one run of this tier
            if newest - max(0, due - 1) >= self.fanout:
                due = newest
        return due

    def compact(self, table: str, everything: bool = False) -> int:
        """Merge runs of the buckets where it is due, all in one job, and split buckets that outgrew ``split_rows``; returns how
        many buckets were touched. Batches that arrive meanwhile stay on top."""
        state = self._state(table)
        if state is None or state["kind"] != "runs":
            return 0
        chosen: dict[str, list[dict]] = {}
        for bucket, runs in state["buckets"].items():
            due = self._due(runs, everything)
            grown = len(runs) == 1 and runs[0]["rows"] > self.split_rows
            if due or grown:
                chosen[bucket] = runs[len(runs) - max(due, 1) :]
        if not chosen:
            return 0
        target: dict[str, list[str]] = {}
        for bucket, runs in chosen.items():
            depth, value = map(int, bucket.split("-"))
            rows, whole = sum(r["rows"] for r in runs), len(runs) == len(state["buckets"][bucket])
            more = min(BITS - depth, max(0, math.ceil(math.log2(rows / self.split_rows)))) if whole and rows > self.split_rows else 0
            target[bucket] = [bucket_name(depth + more, value + (k << depth)) for k in range(1 << more)]
        names = [n for b in state["buckets"] for n in target.get(b, [b])]
        folder = f"v={uuid.uuid4().hex}"
        path = f"{self.path(table)}/data/{folder}"
        merged = self._read_runs(table, state, chosen)
        self._balanced(merged.withColumn(BUCKET, self.bucket_of(state["keys"], names)), [BUCKET]).write.partitionBy(BUCKET).parquet(path)
        written = self._rows_of(path, merged.schema)

        def change(now):
            buckets = {}
            for bucket, runs in now["buckets"].items():
                old = chosen.get(bucket)
                if old is None:
                    buckets[bucket] = runs
                    continue
                at = next((i for i in range(len(runs)) if runs[i : i + len(old)] == old), None)
                if at is None or (len(target[bucket]) > 1 and len(runs) != len(old)):
                    raise Conflict(f"{table}: bucket {bucket} was changed while it was merged")
                tier = 1 + max(r["tier"] for r in old)
                for name in target[bucket]:
                    new = [{"path": f"{folder}/{BUCKET}={name}", "rows": written[name], "tier": tier}] if name in written else []
                    buckets[name] = [*runs[:at], *new, *runs[at + len(old) :]]
            if any(b not in now["buckets"] for b in chosen):
                raise Conflict(f"{table}: a bucket was split while it was merged")
            return {**now, "buckets": buckets}

        self.publish(Staged(table, change, folder, written))
        return len(chosen)

    # --- clean-up ---

    @staticmethod
    def _folders(state: dict) -> set[str]:
        if state["kind"] == "whole":
            return {state["folder"]}
        if state["kind"] == "files":
            return {f["path"] for f in state["files"]}
        return {r["path"] for runs in state.get("buckets", {}).values() for r in runs}

    def vacuum(self, keep: int = 10) -> int:
        """Delete the folders, states and commits that only commits before the newest ``keep`` name; returns how many folders.
        Commits with arrivals that a keyed table hasn't worked in yet are kept, and so is what is staged."""
        numbers = self.log.numbers()
        first = numbers[-keep:][0] if numbers else 0
        latest = self.log.latest()
        for table in latest["tables"]:
            state = self.log.state(latest, table)
            if state.get("through"):
                first = min(first, state["through"] + 1)
        live: dict[str, set[str]] = {}
        old: dict[str, set[str]] = {}
        names: tuple[set[str], set[str]] = (set(), set())
        for number in numbers:
            commit = self.log.at(number)
            for table, name in commit["tables"].items():
                names[number >= first].add(name)
                (live if number >= first else old).setdefault(table, set()).update(self._folders(self.log.state(commit, table)))
        removed = 0
        for table, folders in old.items():
            for folder in sorted(folders - live.get(table, set())):
                removed += self.log.files.delete(f"{self.path(table)}/data/{folder}")
        for number in numbers:
            if number < first:
                self.log.files.delete(self.log._path(number))
        for name in names[False] - names[True]:
            self.log.files.delete(f"{self.root}/_states/{name}")
        return removed
