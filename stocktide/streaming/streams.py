"""Streaming sources, event-time operators and sinks."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from stocktide.operators.common import first_per_key
from stocktide.sources.commits import CommitLog, Conflict


def file_stream(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet",
                name_glob: str | None = None, max_files: int | None = None) -> DataFrame:
    """A stream of the files under a directory; only files not seen before are read.

    With ``availableNow`` and a checkpoint this is the incremental batch ingest.
    """
    reader = spark.readStream.schema(schema).format(fmt)
    if fmt == "csv":
        reader = reader.option("header", True)
    if name_glob:
        reader = reader.option("pathGlobFilter", name_glob)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)


def run_to_files(stream: DataFrame, out: str, checkpoint: str, partition_by: Sequence[str] = ()) -> None:
    """Process everything available into parquet files, exactly once, then stop."""
    writer = stream.writeStream.format("parquet").option("checkpointLocation", checkpoint).trigger(availableNow=True)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.start(out).awaitTermination()


def _event_time(events: DataFrame, time: str) -> DataFrame:
    """Watermarks need TIMESTAMP; zone-less readings are cast under the session zone, pinned to UTC."""
    return events.withColumn(time, F.col(time).cast("timestamp"))


def _zoneless(name: str) -> Column:
    return F.col(name).cast("timestamp_ntz")


def tumbling_counts(events: DataFrame, time: str, keys: Sequence[str], width: str = "1 hour",
                    lateness: str = "10 minutes", slide: str | None = None, value: str | None = None) -> DataFrame:
    """Count (and sum of ``value``) per event-time window and key; ``slide`` makes the window hop."""
    measures = [F.count("*").alias("events")]
    if value:
        measures.append(F.sum(value).alias(f"sum_{value}"))
    window = F.window(time, width, slide) if slide else F.window(time, width)
    return (
        _event_time(events, time).withWatermark(time, lateness)
        .groupBy(window.alias("w"), *keys)
        .agg(*measures)
        .select(_zoneless("w.start").alias("window_start"), _zoneless("w.end").alias("window_end"), *keys,
                *[F.col(n) for n in ["events"] + ([f"sum_{value}"] if value else [])])
    )


def session_counts(events: DataFrame, time: str, keys: Sequence[str], gap: str = "30 minutes",
                   lateness: str = "10 minutes") -> DataFrame:
    """Events per session of each key; a session ends after ``gap`` without an event."""
    return (
        _event_time(events, time).withWatermark(time, lateness)
        .groupBy(F.session_window(time, gap).alias("w"), *keys)
        .agg(F.count("*").alias("events"))
        .select(_zoneless("w.start").alias("session_start"), _zoneless("w.end").alias("session_end"), *keys, "events")
    )


def without_repeats(events: DataFrame, time: str, keys: Sequence[str], within: str = "1 hour") -> DataFrame:
    """Drop events whose keys were already seen within the watermark delay."""
    kept = _event_time(events, time).withWatermark(time, within).dropDuplicatesWithinWatermark(list(keys))
    return kept.withColumn(time, _zoneless(time))


class LateSplit:
    """Splits a stream at its watermark without losing a row: what is on time and what comes behind.

    The watermark of a micro-batch is the latest event time of the batches before it less ``lateness``. Every batch is written
    to a ``batch_id`` folder of its own, its rows behind the watermark apart, together with the latest time it brought, so a
    replayed batch finds the watermark it had and overwrites itself. A row without a time is on time. ``late`` is what a late
    run works in; each of its batches is handed out once by ``replay``.
    """

    def __init__(self, spark: SparkSession, path: str, time: str, lateness: str):
        self.spark, self.path, self.time, self.lateness = spark, path.rstrip("/"), time, lateness
        self.log = CommitLog(spark, f"{self.path}/replayed")

    def _marks(self) -> DataFrame:
        return self.spark.read.schema("latest timestamp_ntz, batch_id bigint").parquet(f"{self.path}/marks")

    def watermark(self, batch_id: int) -> dt.datetime | None:
        """Rows of a batch before this instant are late."""
        if not self.log.files.names(f"{self.path}/marks"):
            return None
        earlier = self._marks().where(F.col("batch_id") < batch_id)
        return earlier.select((F.max("latest") - F.expr(f"interval {self.lateness}")).alias("w")).first().w

    def write_batch(self, batch: DataFrame, batch_id: int) -> None:
        mark = self.watermark(batch_id)
        late = F.lit(False) if mark is None else F.coalesce(_zoneless(self.time) < F.lit(mark).cast("timestamp_ntz"), F.lit(False))
        seen = Observation()
        # the latest time is observed during the write; the mark follows it, and a batch without one is written again
        observed = batch.withColumn("_late", late).observe(seen, F.max(_zoneless(self.time)).cast("string").alias("latest"))
        observed.write.mode("overwrite").partitionBy("_late").parquet(f"{self.path}/rows/batch_id={batch_id}")
        latest = self.spark.createDataFrame([(seen.get["latest"],)], "latest string").select(F.col("latest").cast("timestamp_ntz"))
        latest.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/marks/batch_id={batch_id}")

    def run(self, stream: DataFrame, checkpoint: str) -> None:
        (stream.writeStream.foreachBatch(self.write_batch).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start().awaitTermination())

    def _rows(self, late: bool, after: int = -1, upto: int | None = None) -> DataFrame:
        rows = self.spark.read.parquet(f"{self.path}/rows").where(F.col("_late") == late).where(F.col("batch_id") > after)
        return (rows if upto is None else rows.where(F.col("batch_id") <= upto)).drop("_late")

    def on_time(self) -> DataFrame:
        return self._rows(False)

    def late(self) -> DataFrame:
        return self._rows(True)

    def replay(self, merge: Callable[[DataFrame], None]) -> int:
        """Hand the late rows of the batches that weren't replayed yet to ``merge``, which must stand being given rows again;
        returns the last batch replayed. The mark moves after ``merge``, so a failure repeats it and loses nothing."""
        state = self.log.state(self.log.latest(), "late")
        done = state["through"] if state else -1
        last = self._marks().agg(F.max("batch_id")).first()[0]
        if last is None or last <= done:
            return done
        merge(self._rows(True, done, last).drop("batch_id"))

        def moved(now):
            return {"through": max(last, now["through"] if now else -1)}

        self.log.commit({"late": moved})
        return last


class UpsertSink:
    """Keeps the latest row per key from a stream.

    Every micro-batch is reduced to its latest row per key and written to its own ``batch_id`` folder, so a batch costs what it
    brings, not the size of the table, and a replayed batch overwrites itself. Every ``compact_every`` batches those written so
    far are merged into a base, and a commit records up to which batch: a read takes the base and the batches after it. A
    replayed batch that the base holds is left alone; folders that were merged are deleted when the next base is in force.
    """

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], order: Sequence[Column],
                 prepare: Callable[[DataFrame], DataFrame] | None = None, compact_every: int = 20):
        self.spark = spark
        self.path = path.rstrip("/")
        self.keys = list(keys)
        self.order = list(order)
        self.prepare = prepare or (lambda df: df)
        self.compact_every = compact_every
        self.log = CommitLog(spark, f"{self.path}/base")

    def _base(self) -> dict:
        return self.log.state(self.log.latest(), "base") or {"folder": None, "through": -1, "before": -1}

    def _batches(self) -> list[int]:
        return sorted(int(n.split("=")[1]) for n in self.log.files.names(self.path) if n.startswith("batch_id="))

    def write_batch(self, batch: DataFrame, batch_id: int) -> None:
        if batch_id <= self._base()["through"]:
            return
        latest = first_per_key(self.prepare(batch), self.keys, self.order)
        latest.write.mode("overwrite").parquet(f"{self.path}/batch_id={batch_id}")
        if batch_id - self._base()["through"] >= self.compact_every:
            self.compact()

    def start(self, stream: DataFrame, checkpoint: str) -> StreamingQuery:
        return (stream.writeStream.foreachBatch(self.write_batch).option("checkpointLocation", checkpoint)
                .trigger(availableNow=True).start())

    def run(self, stream: DataFrame, checkpoint: str) -> None:
        self.start(stream, checkpoint).awaitTermination()

    def _merged(self, base: dict) -> DataFrame:
        """Latest row per key of the base and the batches after it, with the batch it came from."""
        waiting = [f"{self.path}/batch_id={b}" for b in self._batches() if b > base["through"]]
        rows = self.spark.read.option("basePath", self.path).option("mergeSchema", True).parquet(*waiting) if waiting else None
        if base["folder"]:
            merged = self.spark.read.parquet(f"{self.path}/base/{base['folder']}")
            rows = merged if rows is None else merged.unionByName(rows, allowMissingColumns=True)
        if rows is None:
            raise ValueError(f"{self.path}: no batch was written")
        # a later batch wins where the order columns tie
        return first_per_key(rows, self.keys, [*self.order, F.col("batch_id").desc()])

    def read(self) -> DataFrame:
        return self._merged(self._base()).drop("batch_id")

    def compact(self) -> int:
        """Merge base and batches into a new base; returns the batch up to which it reaches."""
        base, batches = self._base(), self._batches()
        through = max(batches, default=-1)
        if through <= base["through"]:
            return base["through"]
        folder = f"v={uuid.uuid4().hex}"
        self._merged(base).write.parquet(f"{self.path}/base/{folder}")

        def change(now):
            if (now or {"through": -1})["through"] != base["through"]:
                raise Conflict(f"{self.path}: another writer merged batches")
            return {"folder": folder, "through": through, "before": base["through"]}

        self.log.commit({"base": change})
        for b in batches:  # readers of the base before may still be at those that it lacked
            if b <= base["through"]:
                self.log.files.delete(f"{self.path}/batch_id={b}")
        if base["folder"] and base["before"] >= 0:
            for name in self.log.files.names(f"{self.path}/base"):
                if name.startswith("v=") and name not in (folder, base["folder"]):
                    self.log.files.delete(f"{self.path}/base/{name}")
        return through

    def compacted(self, base: DataFrame) -> DataFrame:
        """The base table with the streamed rows merged in."""
        return first_per_key(base.unionByName(self.read(), allowMissingColumns=True), self.keys, self.order)
