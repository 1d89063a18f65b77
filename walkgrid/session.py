"""Session helpers: where jobs may cut lineage, and the session used by tests and the bench."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_SCRATCH: set[str] = set()  # folders that are already due to go


def build_session(master: str, app: str = "walkgrid", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    builder = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as the cluster names it in ``spark.checkpoint.dir``.

    A private folder is used only in local mode with the setting absent (tests); a cluster without it is an error.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    local = tempfile.mkdtemp(prefix="walkgrid-")
    _gone_at_exit(spark, local)
    spark.conf.set("spark.checkpoint.dir", local)
    return local


def _gone_at_exit(spark: SparkSession, path: str) -> None:
    """Have the file system delete a folder when the application ends: until then a result may still read it."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(folder)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path in the application's own scratch folder, which goes when the application ends."""
    own = f"{shared_dir(spark)}/walkgrid/{spark.sparkContext.applicationId}"
    if own not in _SCRATCH:
        _SCRATCH.add(own)
        _gone_at_exit(spark, own)
    return f"{own}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back: cuts lineage, survives lost executors.

    Unlike ``checkpoint()`` the copy is columnar, so later readers still get column pruning and pushdown.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
