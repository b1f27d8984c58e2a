"""Layer runs: files to bronze, bronze to silver, silver to gold.

Every table is written, checked in its written form and only then put in force
(write, audit, publish). Failures raise; nothing is swallowed.
"""

from __future__ import annotations

import hashlib
import time
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from stocktide.functions.timeexpr import ts
from stocktide.operators import contracts, crosswalk as xw, freshness, gate, gold, identity, inventory as inv
from stocktide.operators import late, quality, scd2, shipments as shp, unified as uni
from stocktide.operators.common import first_per_key, in_parts, parts_of
from stocktide.session import release
from stocktide.sources.readers import CORRUPT, DOMAINS, load, typed
from stocktide.sources.commits import Conflict
from stocktide.sources.store import BATCH, LATEST, REPLACE, Staged, Store

STAGES = ("bronze", "silver", "gold", "all")
SILVER = {"supplier": "silver.supplier_scd2", "shipment": "silver.shipment", "inventory": "silver.inventory_position"}
LINK = "silver.supply_link"
_POSITIONS = ["silver.inventory_position", "silver.supplier_scd2", "silver.crosswalk", LINK]
#: What each gold table is made from.
GOLD_INPUTS = {
    "unified_supply_chain": [*_POSITIONS, "silver.shipment"], "supplier_performance": [*_POSITIONS, "silver.shipment"],
    "inventory_metrics": _POSITIONS, "shipment_performance": ["silver.shipment"],
}
GOLD = ("unified_supply_chain", "supplier_performance", "inventory_metrics", "shipment_performance")
#: Keys that silver tables are bucketed by.
CROSSWALK = "silver.crosswalk"
CROSSWALK_KEYS = [*xw.KEY, "business_key"]
KEYS = {"supplier": ["business_key"], "shipment": ["shipment_id"], "inventory": inv.SNAPSHOT}


#: Most parts that gold tables are made in, and most folders of a gold table that grow with the number of carriers.
MOST_PARTS, FOLDERS = 8, 5_000
#: How often a step is made anew when other writers come in between.
ATTEMPTS = 8


class Refused(RuntimeError):
    """A written table failed its checks and was not put in force."""


@dataclass
class Job:
    """A run over one store at one instant.

    ``mint``: suppliers that the crosswalk doesn't know get a business key of their own, and the crosswalk its mapping; else
    their natural key stands in.
    """

    store: Store
    as_of: str
    mint: bool = False
    # of a job that makes gold tables: into how many parts the work is divided, and the positions that several tables are made from
    _parts: int = field(default=1, init=False, repr=False)
    _base: Staged | None = field(default=None, init=False, repr=False)

    @property
    def spark(self) -> SparkSession:
        return self.store.spark

    # --- bronze ---

    def ingest(self, domain: str, path: str, fmt: str | None = None, source_system: str | None = None,
               batch: str | None = None) -> int:
        """Validate a file against its contract; valid rows go to bronze and the rest to quarantine, as one batch.

        The same ingest again (domain, path, system and instant, unless ``batch`` names it) takes the place of its rows, so
        a failure half way is mended by repeating the call. The file is read, validated and written once; bronze,
        quarantine and log are made from that. Returns the number of rows put in bronze.
        """
        if domain not in DOMAINS:
            raise ValueError(f"Unknown domain: {domain}")
        spec = DOMAINS[domain]
        contract = contracts.CONTRACTS[f"{domain}_raw"]
        system = source_system or spec.source_system
        day = "".join(c for c in self.as_of[:10] if c.isdigit())
        batch = batch or f"{day}-{hashlib.md5('|'.join((domain, path, system, self.as_of)).encode()).hexdigest()[:12]}"
        raw = load(self.spark, domain, path, self.as_of, fmt, source_system)
        # statuses are compared in lower case, as typed() stores them
        raw = raw.withColumn("status", F.trim(F.lower("status"))) if "status" in raw.columns else raw
        landed = f"{spec.table}_landed"
        self.store.put_batch(contracts.validate(raw, contract), landed, batch, alone=True)
        flagged = self.store.spark.read.parquet(f"{self.store.path(landed)}/{BATCH}={batch}")
        valid = flagged.filter(F.size("_errors") == 0).drop("_errors", CORRUPT)
        # as delivered, whatever the format: text
        quarantined = flagged.filter(F.size("_errors") > 0).select(
            *[F.col(c) if c == "_ingestion_ts" else F.to_json(c).alias(c) if c == "_errors" else F.col(c).cast("string").alias(c)
              for c in flagged.columns])
        seen = Observation()
        self.store.put_batch(quarantined, f"{spec.table}_quarantine", batch)
        self.store.put_batch(contracts.log_row(flagged.drop("_errors"), contract, system, self.as_of),
                             "ops.schema_validation_log", f"{domain}-{batch}")
        self.store.put_batch(typed(valid, domain).observe(seen, F.count(F.lit(1)).alias("rows")), spec.table, batch, arrived=self.as_of)
        return seen.get["rows"]

    # --- silver ---

    def _arrived(self, view: Store, domain: str, batches: list[str]) -> DataFrame:
        spec = DOMAINS[domain]
        return contracts.precheck(view.read_appended(spec.table, batches), spec.required, spec.table).drop(BATCH)

    def crosswalk(self) -> DataFrame:
        return self.store.read(CROSSWALK)

    def _keyed(self, feed: DataFrame, crosswalk: DataFrame) -> DataFrame:
        """The supplier feed with the business keys that the crosswalk has, null where it has none."""
        keyed = feed.withColumns({"source_key": F.col("natural_key"), "entity_type": F.lit("supplier")})
        return xw.resolve_keys(keyed, crosswalk)

    def supplier_changes(self, bronze: DataFrame, crosswalk: DataFrame | None = None) -> DataFrame:
        """The supplier feed with business keys from the crosswalk, natural keys where unmapped.

        Where several systems give one business key a state at one instant, the system first in the trust order survives.
        """
        feed = scd2.conform(bronze)
        resolved = self._keyed(feed, self.crosswalk() if crosswalk is None else crosswalk)
        changes = resolved.withColumns({
            "business_key": F.coalesce("business_key", "natural_key"), "effective_start_ts": F.col("load_ts"),
        }).select(*feed.columns, "effective_start_ts")
        trust = identity.trust_rank(F.col("source_system"), identity.RULES["supplier"])
        return first_per_key(changes, ["business_key", "effective_start_ts"], [trust.asc(), F.col("load_ts").desc_nulls_last()])

    def _stage_minted(self, view: Store, bronze: DataFrame) -> Staged | None:
        """Crosswalk rows for suppliers it doesn't know, as a run of their own; None when it knows all. A crosswalk that changes
        before they are in force is a conflict: the other writer may have mapped one of them."""
        unknown = self._keyed(scd2.conform(bronze), view.read(CROSSWALK)).filter("business_key IS NULL")
        minted = xw.add_mappings(view.empty(CROSSWALK), identity.mint(unknown.select(*xw.KEY).distinct()), self.as_of)
        if minted.isEmpty():
            return None
        staged = view.stage_run(minted, CROSSWALK, CROSSWALK_KEYS, LATEST, ["updated_ts"])
        before, change = view.version(CROSSWALK), staged.change

        def guarded(state):
            if (state["version"] if state else 0) != before:
                raise Conflict(f"{CROSSWALK}: version {before} is no longer in force")
            return change(state)

        staged.change = guarded
        return staged

    def _stage_silver(self, domain: str, view: Store, bronze: DataFrame, through: tuple[int, int] | None) -> tuple[list[Staged], int]:
        """What a batch changes, written as runs: only its own rows, or for suppliers the histories of its keys. And the rows."""
        table, keys, minted = SILVER[domain], KEYS[domain], None
        if domain == "supplier":
            minted = self._stage_minted(view, bronze) if self.mint else None
            crosswalk = view.read(CROSSWALK)
            if minted:
                crosswalk = crosswalk.unionByName(view.read_staged(minted), allowMissingColumns=True)
            changes = self.supplier_changes(bronze, crosswalk)
            held = view.read(table, buckets=view.touched(table, keys, changes)).drop("created_at")
            rows = scd2.correct(held.join(changes.select(*keys).distinct(), keys, "left_semi"), changes)
        elif domain in SILVER:
            model = shp if domain == "shipment" else inv
            rows = model.newest(model.conform(bronze), self.as_of)
        else:
            raise ValueError(f"Unknown domain: {domain}")
        staged = view.stage_run(rows.withColumn("created_at", ts(self.as_of)), table, keys, REPLACE if domain == "supplier" else LATEST, ["load_ts"], through)
        self._audit(domain, view.read_staged(staged))
        return [staged, *([minted] if minted else [])], sum(staged.buckets.values())

    def _audit(self, domain: str, written: DataFrame) -> None:
        measure = {"supplier": quality.supplier_checks, "shipment": quality.shipment_checks,
                   "inventory": quality.inventory_checks}[domain]
        row = measure(written).first().asDict()
        bad = {name: row[name] for name in quality.ACCEPTANCE[domain] if row[name]}
        if bad:
            raise Refused(f"{SILVER[domain]}: {bad}")

    def _write(self, df: DataFrame | list[DataFrame], table: str, audit=None, partition_by: list[str] | None = None) -> tuple[Staged, int, float]:
        """Write and check a whole table without putting it in force; what was staged, its rows and seconds."""
        started = time.monotonic()
        frames = [df] if isinstance(df, DataFrame) else df
        staged = self.store.stage([f.withColumn("created_at", ts(self.as_of)) for f in frames], table, partition_by)
        written = self.store.read_staged(staged)
        if audit:
            audit(written)
        # counted from the footers of what was written
        return staged, written.count(), time.monotonic() - started

    def _measure(self, table: str, rows: int, seconds: float) -> None:
        """Append latency and throughput of a written table; the row count was observed during the write."""
        stage, _, name = table.partition(".")
        row = self.spark.createDataFrame(
            [(f"{stage}-{self.as_of}", stage, name, rows, seconds, rows / seconds)],
            "run_id string, stage string, domain string, rows_out bigint, seconds double, rows_per_second double")
        self.store.append(row, "ops.pipeline_metrics")

    def _work_in(self, domain: str, chosen) -> bool:
        """Stage the batches that ``chosen`` picks from the arrivals and put them in force; anew when another writer's commit
        doesn't go with it. False when there are none."""
        table, source = SILVER.get(domain), DOMAINS[domain].table
        for attempt in range(ATTEMPTS):
            started, view = time.monotonic(), self.store.at()
            arrivals = view.arrivals(source, after=view.through(table))
            picked = chosen(arrivals)
            if not picked:
                return False
            # only when nothing is left out does the table know more than before
            through = (view.through(table), arrivals[-1][0]) if len(picked) == len(arrivals) else None
            staged, rows = self._stage_silver(domain, view, self._arrived(view, domain, [b for _, b, _ in picked]), through)
            try:
                self.store.publish(*staged)
            except Conflict:
                if attempt + 1 == ATTEMPTS:
                    raise
                continue
            self._measure(table, rows, time.monotonic() - started)
            self.tidy(table)
            return True
        raise AssertionError

    def tidy(self, table: str) -> int:
        """Merge a table's runs where that is due; another writer's merge or batch in between leaves it for the next time."""
        try:
            return self.store.compact(table)
        except Conflict:
            return 0

    def conform(self, domain: str) -> int:
        """Bring one silver table up to date with the batches it was not made from yet; returns the version in force.

        What was consumed is recorded as the commit up to which arrivals are worked in, not as a time, so a batch of an earlier
        instant is merged like any other. Only the new batches are read and only their rows (for suppliers: the histories of
        their keys) are written and checked.
        """
        if self.store.version(DOMAINS[domain].table) == 0:
            raise ValueError(f"{DOMAINS[domain].table} holds no batch")
        self._work_in(domain, lambda arrivals: arrivals)
        return self.store.version(SILVER[domain])

    def apply_late(self, domain: str, cutoff_hours: int = 24) -> bool:
        """Work in the waiting batches that arrived within the cutoff, at once; False when there are none.

        Batches are chosen by their instant before anything is read. Those worked in already are in force, whatever their
        instant; those outside the cutoff keep waiting for ``conform``.
        """
        return self._work_in(domain, lambda arrivals: late.within(arrivals, self.as_of, cutoff_hours))

    # --- gold ---

    def silver_tables(self) -> dict[str, DataFrame]:
        return {"supplier": self.store.read(SILVER["supplier"]), "shipment": self.store.read(SILVER["shipment"]),
                "inventory_position": self.store.read(SILVER["inventory"])}

    def open_gate(self, log_to: Store | None = None) -> None:
        """Evaluate the gate for every silver table, log the results and raise when one is blocked."""
        tables, store = self.silver_tables(), log_to or self.store
        blocked = []
        for name in tables:
            blocked += self._checked(name, tables, store)
            self._let_go()
        if blocked:
            raise Refused("; ".join(blocked))

    def _checked(self, name: str, tables: Mapping[str, DataFrame], store: Store) -> list[str]:
        """Log the gate's results for one table; what blocks it."""
        results = gate.run_checks(self.spark, "silver", name, tables, self.as_of).persist()
        verdict = gate.evaluate(results, "silver", name, self.as_of)
        store.append(gate.dq_status_rows(results, self.as_of), "ops.dq_status")
        score = quality.quality_score(tables[name], name)
        store.append(gate.table_status(results, score, f"silver.{name}", self.as_of), "ops.data_quality_status")
        store.append(verdict, "ops.publish_gate_log")
        store.append(gate.alert_rows(results, self.as_of), "ops.alerts")
        blocked = [r.message for r in verdict.filter("NOT can_publish").select("message").collect()]
        results.unpersist()
        return blocked

    def _let_go(self) -> None:
        """Where tables are large, the shuffle files of a finished step go before the next adds its own."""
        if self._parts > 1:
            release(self.spark)

    def _stage_positions(self) -> Staged:
        """The positions that gold tables are made from, written once for all of them."""
        tables, parts = self.silver_tables(), self._parts
        stock, links = (in_parts(df, inv.POSITION, parts) for df in (tables["inventory_position"], self.store.read(LINK)))
        return self.store.stage([uni.positions(s, tables["supplier"], self.crosswalk(), link) for s, link in zip(stock, links)], "work.positions", [])

    def _positions(self) -> DataFrame:
        return self.store.read_staged(self._base)

    def _gold_frame(self, table: str, recent_days: int | None) -> list[DataFrame]:
        """The rows of a gold table in frames that are made one after another: by days, or by a key that rows are summed by."""
        if table not in GOLD:
            raise ValueError(f"Unknown table: {table}")
        shipments, parts = self.store.read(SILVER["shipment"]), self._parts
        if table == "shipment_performance":
            return [gold.shipment_performance(part, self.as_of).sortWithinPartitions("carrier_id", "route_id")
                    for part in in_parts(shipments, ["carrier_id"], parts)]
        base, recent = self._positions(), shp.recent_active(shipments, self.as_of, recent_days)
        if table == "unified_supply_chain":
            return [uni.finish(uni.attach_shipments(mine, near), self.as_of) for mine, near in uni.by_days(base, recent, parts)]
        if table == "supplier_performance":
            # from positions and shipments: the sums need no row per pair
            both = zip(in_parts(base, ["supplier_id"], parts), in_parts(recent, ["carrier_id"], parts))
            return [gold.supplier_performance_direct(mine, moves, self.as_of) for mine, moves in both]
        return [gold.inventory_metrics(part, self.as_of) for part in in_parts(base, ["product_id"], parts)]

    def _folders(self, table: str) -> list[str] | None:
        """Partition columns of a gold table; none, but files sorted by carrier, where there would be a folder for each of very many
        carriers (the gate has seen that all are suppliers). None: those of its schema."""
        many = table == "shipment_performance" and self.store.read(SILVER["supplier"]).filter("is_current").count() > FOLDERS
        return [] if many else None

    def publish(self, table: str = "all", recent_days: int | None = 30) -> None:
        """Publish one gold table, or all, behind the gate; the unified table must pass its own checks.

        All are made from silver as one commit left it, written and checked, and put in force together by one commit: a failure
        at any table leaves those in force that were.
        """
        names = GOLD if table == "all" else (table,)
        if any(n not in GOLD for n in names):
            raise ValueError(f"Unknown table: {table}")
        view = Job(self.store.at(), self.as_of)
        view._parts = parts_of(view.store.rows(SILVER["shipment"]) + view.store.rows(SILVER["inventory"]), MOST_PARTS)
        view.open_gate(log_to=self.store)
        if any(_POSITIONS[0] in GOLD_INPUTS[name] for name in names):
            view._base = view._stage_positions()
        written = {}
        try:
            for name in names:
                written[name] = self._write(view._gold_frame(name, recent_days), f"gold.{name}",
                                            self._audit_unified if name == "unified_supply_chain" else None, view._folders(name))
                view._let_go()
        finally:
            if view._base:
                view.store.drop_staged(view._base)
        self.store.publish(*(staged for staged, _, _ in written.values()))
        for name, (_, rows, seconds) in written.items():
            self._measure(f"gold.{name}", rows, seconds)
            self.store.append(self.spark.createDataFrame(
                [(f"gold-{self.as_of}", f"gold.{name}", source, rows) for source in GOLD_INPUTS[name]],
                "run_id string, target string, source_table string, rows_written bigint").withColumn("recorded_ts", ts(self.as_of)),
                "ops.lineage")

    def _audit_unified(self, written: DataFrame) -> None:
        row = quality.gold_unified_check(written).first()
        if row.critical_failures:
            raise Refused(f"gold.unified_supply_chain: {row.missing_count} orphans, {row.invalid_count} repeated keys")

    def record_freshness(self) -> DataFrame:
        """Append the freshness of every domain and its breach alerts; returns the status rows."""
        tables = self.silver_tables()
        state = freshness.refresh({gate.DOMAIN_OF[name]: df for name, df in tables.items()}, self.as_of)
        self.store.append(state, "ops.freshness_status")
        self.store.append(freshness.breach_rows(state, self.as_of), "ops.alerts")
        return state


def run(spark: SparkSession, root: str, stage: str, as_of: str, domain: str = "all",
        sources: Mapping[str, str] | None = None, recent_days: int | None = 30) -> None:
    """Run a stage for one domain or all; ``all`` runs every stage and stops at the first failure.

    ``sources`` maps domains to the file or directory to ingest; ``crosswalk`` and ``link`` in it name parquet of the
    crosswalk and of the supplier of each item and location, which take the place of the tables held.
    """
    if stage not in STAGES:
        raise ValueError(f"Unknown stage: {stage}")
    job = Job(Store(spark, root), as_of)
    domains = list(DOMAINS) if domain == "all" else [domain]
    if stage in ("bronze", "all"):
        for name, table in (("crosswalk", CROSSWALK), ("link", LINK)):
            if sources and name in sources:
                job.store.replace(spark.read.parquet(sources[name]), table, [])
        for name in domains:
            if sources and name in sources:
                job.ingest(name, sources[name])
    if stage in ("silver", "all"):
        for name in domains:
            job.conform(name)
    if stage in ("gold", "all"):
        job.publish("all", recent_days)
        job.record_freshness()
