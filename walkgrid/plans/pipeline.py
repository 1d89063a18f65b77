"""The whole chain as tables: landed files -> indexed -> distances -> scores -> report, skipping what has not changed.

A table is a name, a contract and a function from its input DataFrames to its own; ``run`` walks them in declared
order. Each table is written once and read back, so jobs stay short and lost executors cost one stage.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from walkgrid import __version__
from walkgrid.functions.grid import DEFAULT_GRID, HexGrid, cell_id, cell_q, cell_r
from walkgrid.operators import amenities as am
from walkgrid.operators.nearest import nearest
from walkgrid.operators.quality import error_failures, latest_verdicts, reused_verdicts, run_checks, verdict_tally, write_quality_report
from walkgrid.operators.rollup import hex_rollup
from walkgrid.operators.scores import livability, merged_profile, shard_profiles
from walkgrid.plans.contracts import CONTRACTS, Contract, TableMeta
from walkgrid.plans.ledger import LEDGER_SCHEMA, current_versions, gate, latest_runs, reconcile, stale_tables
from walkgrid.plans.report import boundary_features, hex_features, write_features
from walkgrid.session import materialize
from walkgrid.sources.store import SnapshotStore, Staged, now_stamp, parse_stamp, read_json_table, shard_key

VERDICT_SCHEMA = (
    "asset string, shard string, check_name string, passed boolean, severity string, metadata string, "
    "run_ts timestamp, reused_snapshot boolean, version string"
)


@dataclass(frozen=True)
class Settings:
    grid: HexGrid = DEFAULT_GRID
    mode: str = "exact"
    weights: Mapping[str, float] = field(default_factory=dict)


@dataclass(frozen=True)
class Table:
    meta: TableMeta
    contract: Contract
    build: Callable[[dict[str, DataFrame], Settings], DataFrame]
    inputs: tuple[str, ...] = ()
    shard_column: str | None = None
    per_shard: bool = False  # gate and rebuild shard by shard

    @property
    def name(self) -> str:
        return self.meta.name


def raw_table(name: str, description: str, fetch: Callable[[SparkSession], DataFrame], contract: Contract | None = None) -> Table:
    """A landed source, fetched again once its snapshot is older than the contract allows."""
    contract = contract or CONTRACTS[name]
    if contract.max_days is None:
        raise ValueError(f"{name}: a raw table needs a maximum age")
    meta = TableMeta("bronze", name, description)
    return Table(meta, contract, lambda _inputs, _settings: fetch(SparkSession.active()))


def _traced(paths: DataFrame, grid: HexGrid) -> DataFrame:
    cells = am.traced_lines(paths, "ID_CYCL", grid=grid)
    return cells.select("ID_CYCL", cell_id(10, F.col("q"), F.col("r")).alias("cell_r10"))


def _cell_columns(df: DataFrame) -> DataFrame:
    return df.withColumns({"q": cell_q(F.col("cell_r10")), "r": cell_r(F.col("cell_r10"))})


def _amenities(t: dict[str, DataFrame], s: Settings) -> DataFrame:
    return am.amenities_union(
        t["cell_pois"], t["cell_transit_stops"], t["cell_parks"], _cell_columns(t["cell_bike_paths"]), s.grid
    )


def _distances(t: dict[str, DataFrame], s: Settings) -> DataFrame:
    return nearest(t["cell_addresses"], t["amenities"], mode=s.mode, id_col="ID_UEV", grid=s.grid)


def _scores(t: dict[str, DataFrame], s: Settings) -> DataFrame:
    scored = livability(_cell_columns(t["distances"]), t["municipalities"], s.weights, s.grid)
    return scored.withColumn("cell_r10", cell_id(10, F.col("q"), F.col("r")))


def derived_tables() -> list[Table]:
    def table(layer, name, description, build, *inputs, **kw) -> Table:
        segmentation = kw.get("shard_column") or "snapshot"
        meta = TableMeta(layer, name, description, segmentation=segmentation)
        return Table(meta, CONTRACTS[name], build, inputs, **kw)

    return [
        table("silver", "cell_addresses", "addresses with analysis and shard cell",
              lambda t, s: am.indexed_addresses(t["addresses"], s.grid), "addresses", shard_column="cell_r6"),
        table("silver", "cell_pois", "categorised POIs with cell",
              lambda t, s: am.categorized_pois(t["pois"], s.grid), "pois"),
        table("silver", "cell_transit_stops", "stops with cell",
              lambda t, s: am.indexed(t["transit_stops"], s.grid), "transit_stops"),
        table("silver", "cell_parks", "parks with inside point and cell",
              lambda t, s: am.indexed_parks(t["parks"], s.grid), "parks"),
        table("silver", "cell_bike_paths", "one row per path and cell",
              lambda t, s: _traced(t["bike_paths"], s.grid), "bike_paths"),
        table("silver", "municipalities", "boundaries by name",
              lambda t, s: am.municipalities(t["municipality_boundaries"]), "municipality_boundaries"),
        table("silver", "amenities", "amenity points of all categories", _amenities,
              "cell_pois", "cell_transit_stops", "cell_parks", "cell_bike_paths"),
        table("silver", "distances", "nearest amenity per address and category", _distances,
              "cell_addresses", "amenities", shard_column="cell_r6", per_shard=True),
        table("gold", "livability_score", "scores and blend per cell", _scores, "distances", "municipalities"),
    ]


class Run:
    """One pass over the tables against a store; the ledger and the verdicts are tables of the same store root.

    A table is audited before it is published: its data is staged, checked, and only then made its version, with one row in the
    ledger that carries what was gathered of it and the tally of its verdicts. A run that dies in between leaves the old version.
    Checks report; they do not hold a version back.
    """

    def __init__(
        self, store: SnapshotStore, raw: list[Table], settings: Settings = Settings(), now: datetime | None = None, derived: list[Table] | None = None
    ) -> None:
        self.spark = store.spark
        self.store = store
        self.settings = settings
        self.tables = [*raw, *(derived_tables() if derived is None else derived)]
        self.by_name = {t.name: t for t in self.tables}
        self.now = now or datetime.now(timezone.utc).replace(tzinfo=None)
        self.results: dict[str, bool] = {}  # table -> reused

    def ledger(self) -> DataFrame:
        return read_json_table(self.spark, f"{self.store.root}/ledger", LEDGER_SCHEMA)

    def verdicts(self) -> DataFrame:
        return read_json_table(self.spark, f"{self.store.root}/verdicts", VERDICT_SCHEMA)

    def read(self, name: str) -> DataFrame:
        return self.store.read(self.by_name[name].meta.location)

    def _code(self, table: Table) -> str:
        """Code version plus whatever settings the table's result depends on."""
        parts = {"grid": vars(self.settings.grid)}
        if table.name == "distances":
            parts["mode"] = self.settings.mode
        if table.name == "livability_score":
            parts["weights"] = dict(sorted(self.settings.weights.items()))
        return f"{__version__} {json.dumps(parts)}"

    def _record(self, rows: DataFrame) -> None:
        """Append to the ledger; columns not given are null."""
        rows.withColumn("run_ts", F.lit(self.now)).write.mode("append").json(f"{self.store.root}/ledger")

    def _record_table(self, table: Table, version: str, inputs: dict[str, str] | None, hit: bool, metadata: dict | None = None) -> None:
        row = (table.name, version, self._code(table), inputs, hit, None if metadata is None else json.dumps(metadata))
        schema = "asset string, version string, code_version string, input_versions map<string,string>, hit boolean, metadata string"
        self._record(self.spark.createDataFrame([row], schema))

    def _publish(self, table: Table, staged: Staged) -> dict:
        """Check staged data, publish it, and say what is known of it: for the ledger."""
        location = table.meta.location
        fresh = run_checks(self.store.staged(staged), table.contract, location, table.shard_column)
        fresh = materialize(fresh.withColumns({"run_ts": F.lit(self.now), "reused_snapshot": F.lit(False), "version": F.lit(staged.stamp)}), "verdicts")
        tally = verdict_tally(fresh).first()
        self.store.publish(staged)
        fresh.write.mode("append").json(f"{self.store.root}/verdicts")
        if table.name == "distances":
            profiles = shard_profiles(self.store.staged(staged), shard_key(F.col(table.shard_column)))
            profiles.withColumn("stamp", F.lit(staged.stamp)).write.mode("append").parquet(self._profiles(table.name))
        return {**staged.metadata, "columns": dict(self.store.staged(staged).dtypes), "verdicts": tally["summary"]}

    def _profiles(self, name: str) -> str:
        return f"{self.store.root}/profiles/{name}"

    def distance_profile(self) -> DataFrame:
        """Profile of all current shards from what was kept of each when it was written: no shard is read again."""
        current = self.store.shards(self.by_name["distances"].meta.location)
        kept = self.spark.read.parquet(self._profiles("distances"))
        return merged_profile(kept.join(current, ["shard", "stamp"], "left_semi"))

    def _repeat_checks(self, table: Table, shards: DataFrame) -> None:
        location = table.meta.location
        reused = shards.select(F.lit(location).alias("asset"), "shard")
        prior = latest_verdicts(self.verdicts().filter(F.col("asset") == location))
        prior = prior.drop("run_ts", "reused_snapshot")
        again = reused_verdicts(prior, reused).withColumn("run_ts", F.lit(self.now))
        again.write.mode("append").json(f"{self.store.root}/verdicts")

    def _versions(self, table: Table) -> DataFrame:
        """(asset, version) of the inputs now."""
        runs = latest_runs(self.ledger()).filter(F.col("asset").isin(*table.inputs))
        return current_versions(runs)

    def _stale(self, table: Table, stamp: str | None) -> bool:
        snapshots = self.spark.createDataFrame([(table.name, stamp)], "asset string, stamp string").select(
            "asset", parse_stamp(F.col("stamp")).alias("ts")
        )
        limits = self.spark.createDataFrame([(table.name, table.contract.max_days)], "asset string, max_days int")
        return stale_tables(snapshots, limits, F.lit(self.now)).first()["stale"]

    def _whole(self, table: Table) -> None:
        location = table.meta.location
        inputs: dict[str, str] = {}
        if not table.inputs:
            version = self.store.latest_stamp(location)
            hit = not self._stale(table, version)
        else:
            wanted = self.spark.createDataFrame(
                [(table.name, None, self._code(table))], "asset string, shard string, code_version string"
            )
            upstreams = self.spark.createDataFrame([(table.name, u) for u in table.inputs], "asset string, upstream string")
            versions = self._versions(table)
            decision = gate(wanted, self.ledger(), upstreams, versions).first()
            hit, version = decision["hit"], decision["version"]
            inputs = {r["asset"]: r["version"] for r in versions.collect()}  # one row per input table
        metadata = None
        if not hit:
            built = table.build({n: self.read(n) for n in table.inputs}, self.settings)
            staged = self.store.stage(built, location, table.shard_column)
            version, metadata = staged.stamp, self._publish(table, staged)
        self._record_table(table, version, inputs, hit, metadata)
        if hit and table.shard_column:
            self._repeat_checks(table, self.store.shards(location).select("shard"))
        elif hit:
            self._repeat_checks(table, self.spark.createDataFrame([(None,)], "shard string"))
        self.results[table.name] = hit

    def _by_shard(self, table: Table) -> None:
        """Rebuild just the shards whose own input shard or whose whole-table inputs moved."""
        location = table.meta.location
        sharded = next(n for n in table.inputs if self.by_name[n].shard_column)
        whole = [n for n in table.inputs if n != sharded]
        registry = self.store.shards(self.by_name[sharded].meta.location)
        key = lambda name: F.concat(F.lit(f"{name}/"), F.col("shard"))
        versions = registry.select(key(sharded).alias("asset"), F.col("stamp").alias("version")).unionByName(
            current_versions(latest_runs(self.ledger()).filter(F.col("asset").isin(*whole)))
        )
        upstreams = registry.select(
            key(table.name).alias("asset"),
            F.explode(F.array(key(sharded), *[F.lit(w) for w in whole])).alias("upstream"),
        )
        wanted = registry.select(
            key(table.name).alias("asset"), "shard", F.lit(self._code(table)).alias("code_version")
        )
        decided = gate(wanted, self.ledger(), upstreams, versions).select("asset", "shard", "version", "hit", "miss_reason")
        decided = materialize(decided, "gate")  # the ledger grows below; the decision must not move with it
        changed = decided.filter(~F.col("hit")).select("shard")
        all_reused = changed.isEmpty()
        metadata = None
        if not all_reused:
            inputs = {n: self.read(n) for n in table.inputs}
            own = shard_key(F.col(table.shard_column))
            inputs[sharded] = inputs[sharded].withColumn("_shard", own).join(changed.withColumnRenamed("shard", "_shard"), "_shard", "left_semi").drop("_shard")
            first = self.store.latest_stamp(location) is None
            built = table.build(inputs, self.settings)
            staged = self.store.stage(built, location, table.shard_column, None if first else changed)
            stamp, metadata = staged.stamp, self._publish(table, staged)
            known = versions.withColumnsRenamed({"asset": "upstream", "version": "consumed"})
            taken = (
                upstreams.join(known, "upstream")
                .groupBy("asset")
                # one entry per input table
                .agg(F.map_from_entries(F.collect_list(F.struct("upstream", "consumed"))).alias("input_versions"))
            )
            self._record(
                decided.filter(~F.col("hit")).join(taken, "asset").select(
                    "asset", "shard", F.lit(stamp).alias("version"), F.lit(self._code(table)).alias("code_version"),
                    "input_versions", "hit",
                )
            )
        self._repeat_checks(table, decided.filter("hit").select("shard"))
        gone = reconcile(self.store.shards(location), registry).filter(F.col("action") == "drop")
        if not gone.isEmpty():
            self.store.drop_shards(location, gone, table.shard_column)
        shards = self.store.shards(location).select(F.lit(table.name).alias("asset"), "shard", F.col("stamp").alias("version"))
        fingerprint = current_versions(shards).first()
        self._record_table(table, fingerprint["version"], None, all_reused, metadata)
        self.results[table.name] = all_reused

    def run(self) -> dict[str, bool]:
        """Bring every table up to date and report on it; says per table whether its snapshot was reused."""
        for table in self.tables:
            self._by_shard(table) if table.per_shard else self._whole(table)
        self.write_report()
        return self.results

    def report(self) -> DataFrame:
        """Latest verdict of each check and shard of this run's tables."""
        own = self.verdicts().filter(F.col("asset").isin(*[t.meta.location for t in self.tables]))
        return latest_verdicts(own)

    def write_report(self) -> None:
        """The quality report, one for each run, and the map's features once there are scores."""
        stamp = now_stamp()
        write_quality_report(self.report(), f"{self.store.root}/reports/quality/run={stamp}", stamp)
        if self.results.get("livability_score") is False:
            hexes = hex_features(hex_rollup(_cell_columns(self.read("livability_score")), grid=self.settings.grid))
            write_features(hexes, f"{self.store.root}/reports/hexes/run={stamp}")
            write_features(boundary_features(self.read("municipalities")), f"{self.store.root}/reports/boundaries/run={stamp}")

    def failures(self) -> DataFrame:
        """What the report would alert on."""
        return error_failures(self.report())
