"""Versioned snapshots on any Hadoop file system.

Layout: ``{root}/{layer}/{table}/data/stamp=<stamp>[/<shard column>=<shard>]/*.parquet`` and, next to it, ``log/version=<stamp>``: small JSON
tables, one for each version, that hold the whole registry of it: a row for the table and, if it is sharded, a row for each shard
with the stamp of its data. A write has two steps: ``stage`` writes data, ``publish`` the version; readers only ever see published
versions, so what a crash leaves between the steps is never read. One writer per table is assumed.
"""

from __future__ import annotations

import json
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from walkgrid.constants import STAMP_FORMAT, STAMP_SPARK_FORMAT
from walkgrid.operators.amenities import require_columns

LOG_SCHEMA = "version string, stamp string, shard_column string, shard string, rows long, schema string, metadata string"


def now_stamp() -> str:
    """Sortable UTC stamp: snapshot name and data version in one."""
    return datetime.now(timezone.utc).strftime(STAMP_FORMAT)


def parse_stamp(stamp: Column) -> Column:
    return F.to_timestamp(stamp, STAMP_SPARK_FORMAT)


def stamp_of(path: Column) -> Column:
    """Stamp in a snapshot path."""
    return F.regexp_extract(path, r"stamp=([^/]+)", 1)


def format_size(size_bytes: Column) -> Column:
    return F.format_string("%.2f MB", size_bytes / (1024 * 1024))


def shard_key(value: Column) -> Column:
    """Name of a shard in the registry; null and empty text share one directory, so they are one shard."""
    return F.coalesce(value.cast("string"), F.lit(""))


def preview(df: DataFrame, n: int = 5) -> DataFrame:
    """First rows without geometry arrays."""
    nested = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.ArrayType, T.StructType))]
    return df.drop(*nested).limit(n)


def read_json_table(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Append-only JSON table; empty while nothing has been written."""
    try:
        return spark.read.schema(schema).json(path)
    except AnalysisException as missing:
        if missing.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], schema)
        raise


@dataclass(frozen=True)
class Staged:
    """Data that is written under a stamp but not yet the table's version; ``metadata`` was gathered while it was written."""

    location: str
    stamp: str
    schema: T.StructType
    metadata: dict
    shard_column: str | None = None
    only: DataFrame | None = None  # shards (column shard) that it replaces; none: all


class SnapshotStore:
    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark = spark
        self.root = root.rstrip("/")

    def _data(self, location: str) -> str:
        return f"{self.root}/{location}/data"

    def _log(self, location: str) -> str:
        return f"{self.root}/{location}/log"

    def log(self, location: str) -> DataFrame:
        """Registries of all versions."""
        return read_json_table(self.spark, self._log(location), LOG_SCHEMA)

    def latest_stamp(self, location: str) -> str | None:
        """The newest version, from the names of the log's folders; no row is read."""
        try:
            files = self.spark.read.format("binaryFile").option("recursiveFileLookup", True).load(self._log(location))
        except AnalysisException as missing:
            if missing.getCondition() == "PATH_NOT_FOUND":
                return None
            raise
        return files.agg(F.max(F.regexp_extract("path", r"version=([^/]+)", 1))).first()[0]

    def registry(self, location: str) -> DataFrame:
        """The newest version's rows: as many as the table has shards, and one, however long its history."""
        version = self.latest_stamp(location)
        if version is None:
            return self.spark.createDataFrame([], LOG_SCHEMA)
        return self.spark.read.schema(LOG_SCHEMA).json(f"{self._log(location)}/version={version}")

    def _write_registry(self, location: str, version: str, rows: DataFrame) -> None:
        named = rows.withColumn("version", F.lit(version)).select(*T.StructType.fromDDL(LOG_SCHEMA).names)
        named.coalesce(1).write.json(f"{self._log(location)}/version={version}")

    def stage(self, df: DataFrame, location: str, shard_column: str | None = None, only: DataFrame | None = None, stamp: str | None = None) -> Staged:
        """Write data without making it the table's version. Rows, and missing values by column, are counted in the same job.

        With ``shard_column`` all shards are written in one job, one directory each, under one stamp. Rows without a shard (null or
        empty text, which are one directory on disk) are a shard of their own, named by the empty text. The rebalance hint gathers a
        shard's rows into few files but splits a crowded shard over several tasks. An empty table is written like any other.
        """
        if shard_column is not None:
            require_columns(df, shard_column)
        stamp = stamp or now_stamp()
        seen = Observation()
        nulls = [F.count_if(F.col(f"`{c}`").isNull()).alias(f"null_{i}") for i, c in enumerate(df.columns)]
        path = f"{self._data(location)}/stamp={stamp}"
        if shard_column is None:
            df.observe(seen, F.count(F.lit(1)).alias("rows"), *nulls).write.parquet(path)
        else:
            df.hint("rebalance", shard_column).observe(seen, F.count(F.lit(1)).alias("rows"), *nulls).write.partitionBy(shard_column).parquet(path)
        metadata = {"rows": seen.get["rows"], "nulls": {c: n for i, c in enumerate(df.columns) if (n := seen.get[f"null_{i}"])}}
        staged = Staged(location, stamp, df.schema, metadata, shard_column, only)
        metadata["preview"] = [json.loads(r) for r in preview(self.staged(staged)).toJSON().collect()]
        return staged

    def staged(self, staged: Staged) -> DataFrame:
        """The data of a write that is not published yet."""
        return self.spark.read.schema(staged.schema).parquet(f"{self._data(staged.location)}/stamp={staged.stamp}")

    def publish(self, staged: Staged) -> str:
        """Make staged data the table's version, and return its stamp. Shards that it does not replace keep their data; without
        ``only`` shards that it does not have vanish, and the version advances even if there are no rows at all."""
        stamp, column = F.lit(staged.stamp).alias("stamp"), F.lit(staged.shard_column).cast("string").alias("shard_column")
        head = self.spark.createDataFrame(
            [(staged.stamp, staged.shard_column, None, staged.metadata["rows"], json.dumps(staged.schema.jsonValue()), json.dumps(staged.metadata))],
            "stamp string, shard_column string, shard string, rows long, schema string, metadata string",
        )
        rows = head
        if staged.shard_column is not None:
            written = self.staged(staged).groupBy(shard_key(F.col(staged.shard_column)).alias("shard")).agg(F.count("*").alias("rows"))
            if staged.only is not None:
                replaced = staged.only.select(shard_key(F.col("shard")).alias("shard")).distinct()
                written = replaced.join(written, "shard", "left").fillna(0, ["rows"])
                kept = self.registry(staged.location).filter("shard is not null").join(replaced, "shard", "left_anti")
                rows = rows.unionByName(kept.select("stamp", "shard_column", "shard", "rows"), allowMissingColumns=True)
            rows = rows.unionByName(written.select(stamp, column, "shard", "rows"), allowMissingColumns=True)
        self._write_registry(staged.location, staged.stamp, rows)
        return staged.stamp

    def write(
        self, df: DataFrame, location: str, shard_column: str | None = None, shard: str | None = None,
        stamp: str | None = None,
    ) -> str:
        """Stage and publish one snapshot and return its stamp. With ``shard`` only that shard's rows are kept and replaced."""
        if shard is None:
            return self.publish(self.stage(df, location, stamp=stamp))
        if shard_column is None:
            raise ValueError("a shard needs the column it is taken from")
        require_columns(df, shard_column)
        only = self.spark.createDataFrame([(shard,)], "shard string")
        return self.write_sharded(df.filter(shard_key(F.col(shard_column)) == shard), location, shard_column, only, stamp)

    def write_sharded(
        self, df: DataFrame, location: str, shard_column: str, only: DataFrame | None = None, stamp: str | None = None
    ) -> str:
        """Stage and publish all shards, or those named by ``only`` (column shard; others keep their snapshot)."""
        return self.publish(self.stage(df, location, shard_column, only, stamp))

    def shards(self, location: str) -> DataFrame:
        """(shard, stamp) of every current shard."""
        return self.registry(location).filter("shard is not null").select("shard", "stamp")

    def drop_shards(self, location: str, shards: DataFrame, shard_column: str) -> None:
        """Take shards (column shard) out of the registry; their files stay for older readers."""
        gone = shards.select(shard_key(F.col("shard")).alias("shard")).distinct()
        now = self.registry(location)
        kept = now.filter("shard is null").unionByName(now.filter("shard is not null").join(gone, "shard", "left_anti").select(*now.columns))
        self._write_registry(location, now_stamp(), kept)

    def read(self, location: str, shard: str | None = None) -> DataFrame:
        """The table's version; for a sharded table the data of every current shard, or of one ``shard``.

        A single shard is a partition filter, so the scan prunes to its directory.
        """
        registry = self.registry(location)
        head = registry.filter("shard is null").first()
        if head is None:
            raise FileNotFoundError(f"no snapshot under {self.root}/{location}")
        schema, column, data = T.StructType.fromJson(json.loads(head["schema"])), head["shard_column"], self._data(location)
        if column is None:
            return self.spark.read.schema(schema).parquet(f"{data}/stamp={head['stamp']}")
        written = sorted(r["stamp"] for r in registry.filter("shard is not null").select("stamp").distinct().collect())  # one per current shard at most
        if not written:
            return self.spark.createDataFrame([], schema)
        full = T.StructType([*schema.fields, T.StructField("stamp", T.StringType())])
        df = self.spark.read.schema(full).option("basePath", data).parquet(*[f"{data}/stamp={s}" for s in written])
        if shard is not None:
            df = df.filter(F.col(column) == shard if shard else shard_key(F.col(column)) == shard)
        # The registry decides, however many writes there were: a stamp may hold shards that were replaced or dropped since.
        current = registry.filter("shard is not null").select(F.col("shard").alias("_shard"), "stamp")
        return df.withColumn("_shard", shard_key(F.col(column))).join(current, ["_shard", "stamp"], "left_semi").select(*schema.names)

    def snapshot_metadata(self, location: str) -> DataFrame:
        """One row per snapshot: rows, shards, schema, what was gathered when it was written, size on disk. Reads file listings and
        the log, no data."""
        sizes = (
            self.spark.read.format("binaryFile").option("recursiveFileLookup", True)
            .option("pathGlobFilter", "*.parquet").load(self._data(location))
            .groupBy(stamp_of(F.col("path")).alias("stamp"))
            .agg(F.sum("length").alias("bytes"))
        )
        heads = self.log(location).filter("shard is null").dropDuplicates(["stamp"]).select("stamp", "rows", "schema", "metadata")
        shards = self.log(location).filter("shard is not null").select("stamp", "shard").distinct().groupBy("stamp").agg(F.count("*").alias("shards"))
        out = heads.join(shards, "stamp", "left").join(sizes, "stamp", "left").withColumn("shards", F.coalesce("shards", F.lit(0)))
        return out.withColumn("file_size", format_size(F.col("bytes")))
