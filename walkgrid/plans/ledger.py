"""Skip-if-unchanged bookkeeping as joins over an append-only ledger of materialisations.

Ledger rows: asset, shard (null for whole tables), run_ts, version, code_version, input_versions (map upstream ->
version consumed), hit, metadata (JSON text).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LEDGER_SCHEMA = (
    "asset string, shard string, run_ts timestamp, version string, code_version string, "
    "input_versions map<string,string>, hit boolean, metadata string"
)

# Texts of miss_reason.
NO_PRIOR = "never built"
NO_INPUTS = "last build names no inputs"
CODE_CHANGED = "built by other code"
UPSTREAM_MISSING = "an input was never built"
UPSTREAM_MOVED = "an input has another version"
NO_VERSION = "last build names no version"


def latest_runs(ledger: DataFrame, order: tuple[str, ...] = ("run_ts", "version")) -> DataFrame:
    """Newest ledger row per (asset, shard); a maximum of structs, so it combines on the map side."""
    rest = [c for c in ledger.columns if c not in ("asset", "shard")]
    newest = F.max_by(F.struct(*rest), F.struct(*order)).alias("x")
    return ledger.groupBy("asset", "shard").agg(newest).select("asset", "shard", "x.*")


def current_versions(latest: DataFrame) -> DataFrame:
    """(asset, version) now: a whole table's own version, or one fingerprint over all shard versions.

    The fingerprint does not depend on order and combines on the map side, so a sharded upstream can be compared
    like any other instead of always counting as changed.
    """
    h = F.xxhash64("shard", "version")
    sharded = F.concat_ws(
        ":",
        F.count("*").cast("string"),
        F.hex(F.bit_xor(h)),
        F.sum(F.pmod(h, F.lit(2**40))).cast("string"),
    )
    return latest.groupBy("asset").agg(
        F.when(F.count("shard") > 0, sharded).otherwise(F.max("version")).alias("version")
    )


def stale_tables(snapshots: DataFrame, limits: DataFrame, now: Column) -> DataFrame:
    """Per table of ``limits`` (asset, max_days): age of its newest snapshot (asset, ts) and whether to fetch again.

    A snapshot exactly ``max_days`` old is still fresh; a table without snapshot is stale.
    """
    newest = snapshots.groupBy("asset").agg(F.max("ts").alias("ts"))
    age = now - F.col("ts")
    return limits.join(newest, "asset", "left").select(
        "asset",
        "max_days",
        F.extract(F.lit("DAY"), age).cast("long").alias("age_days"),
        F.coalesce(age > F.make_dt_interval(F.col("max_days")), F.lit(True)).alias("stale"),
    )


def gate(wanted: DataFrame, ledger: DataFrame, upstreams: DataFrame, versions: DataFrame) -> DataFrame:
    """Decide reuse for every wanted (asset, shard, code_version).

    A hit needs a prior run with the same code version whose recorded version of each upstream (asset, upstream) is
    the upstream's current one (asset, version in ``versions``). Rows: wanted columns, version, hit, miss_reason.
    """
    prior = latest_runs(ledger).select(
        F.col("asset").alias("_asset"),
        F.col("shard").alias("_shard"),
        F.col("version").alias("_version"),
        F.col("code_version").alias("_code"),
        F.col("input_versions").alias("_inputs"),
        F.lit(True).alias("_ran"),
    )
    same = (F.col("asset") == F.col("_asset")) & F.col("shard").eqNullSafe(F.col("_shard"))
    known = versions.select(F.col("asset").alias("_up"), F.col("version").alias("_up_version"))
    needs = (
        upstreams.join(known, F.col("upstream") == F.col("_up"), "left")
        .groupBy("asset")
        .agg(
            F.count_if(F.col("_up").isNull()).alias("_never"),
            # few upstreams per table, so the map stays small
            F.map_from_entries(F.collect_list(F.struct("upstream", "_up_version"))).alias("_now"),
        )
        .withColumnRenamed("asset", "_needs")
    )
    moved = F.exists(
        F.map_keys("_now"),
        lambda u: ~F.try_element_at("_inputs", u).eqNullSafe(F.try_element_at("_now", u)),
    )
    reason = (
        F.when(F.col("_ran").isNull(), NO_PRIOR)
        .when(F.col("_inputs").isNull(), NO_INPUTS)
        .when(~F.col("_code").eqNullSafe(F.col("code_version")), CODE_CHANGED)
        .when(F.col("_never") > 0, UPSTREAM_MISSING)
        .when(F.col("_now").isNotNull() & moved, UPSTREAM_MOVED)
        .when(F.col("_version").isNull(), NO_VERSION)
    )
    return (
        wanted.join(prior, same, "left")
        .join(needs, F.col("asset") == F.col("_needs"), "left")
        .withColumn("miss_reason", reason)
        .select(
            *wanted.columns,
            F.col("_version").alias("version"),
            F.col("miss_reason").isNull().alias("hit"),
            "miss_reason",
        )
    )


def reconcile(existing: DataFrame, desired: DataFrame) -> DataFrame:
    """(shard, action) with action ``add``, ``drop`` or ``keep``: from the shards there are to those wanted."""
    have, want = existing.select("shard").distinct(), desired.select("shard").distinct()
    both = have.withColumn("_have", F.lit(True)).join(want.withColumn("_want", F.lit(True)), "shard", "full")
    action = F.when(F.col("_have").isNull(), "add").when(F.col("_want").isNull(), "drop").otherwise("keep")
    return both.select("shard", action.alias("action"))
