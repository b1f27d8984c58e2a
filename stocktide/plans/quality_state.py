"""Quality of a growing table from what each batch brings."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from stocktide.operators import quality
from stocktide.sources.commits import Conflict
from stocktide.sources.store import REPLACE, Store


@dataclass
class QualityState:
    """Counters and row digests of a table, kept in a store and brought up to date batch by batch.

    A batch is grouped to digests once and written as such; its counters are summed from that, and the digests that the table
    didn't hold yet are written as a run of a keyed table. Both go in force by one commit. So a batch costs its own rows and a read of the digests in
    the buckets it meets, and the score of the whole table is read off the counters. Two writers that bring digests of one
    bucket conflict: the second is made anew on top of the first, so no row counts as distinct twice.
    """

    store: Store
    table: str

    @property
    def name(self) -> str:
        return f"ops.quality_of_{self.table.replace('.', '_')}"

    def add(self, batch: DataFrame, number: int, attempts: int = 5) -> bool:
        """Count a batch. Batches are numbered from 1 in order; one that is counted already changes nothing (False)."""
        groups = None
        for attempt in range(attempts):
            view = self.store.at()
            held = view._state(self.name) or {}
            before = held.get("through", 0)
            if number <= before:
                return False
            if groups is None:
                path = f"{self.store.path(self.name)}/batches/number={number}"
                found = quality.row_groups(batch, self.table)
                found.write.mode("overwrite").parquet(path)
                groups = self.store.spark.read.schema(found.schema).parquet(path)
                counted = groups.agg(*[c.alias(n) for n, c in quality.row_counters(batch, self.table).items()]).first().asDict()
            digests = groups.select(*quality.DIGEST)
            if held:
                digests = digests.join(view.read(self.name), quality.DIGEST, "left_anti")
            staged = view.stage_run(digests, self.name, quality.DIGEST, REPLACE, (), (before, number))
            counted["uniq"] = sum(staged.buckets.values())
            change = staged.change

            def with_counters(state, change=change, counted=dict(counted)):
                known = (state or {}).get("counters", {})
                return {**change(state), "counters": {n: known.get(n, 0) + v for n, v in counted.items()}}

            staged.change = with_counters
            try:
                self.store.publish(staged)
            except Conflict:
                if attempt + 1 == attempts:
                    raise
                continue
            return True
        raise AssertionError

    def score(self) -> DataFrame:
        """The row of ``quality.quality_score`` for all batches so far, without reading the table."""
        state = self.store._state(self.name)
        if state is None:
            raise ValueError(f"no batch of {self.table} was counted")
        counters = state["counters"]
        row = self.store.spark.createDataFrame([tuple(counters.values())], ", ".join(f"`{n}` bigint" for n in counters))
        return quality.score_of(row, self.table)
