"""Session settings, shared scratch space and lineage cuts."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "millrace", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators are tuned for.

    Partition counts are left to AQE on a cluster: it coalesces small shuffle partitions and splits
    skewed join partitions from the real shuffle sizes.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
        .config("spark.ui.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can read: ``spark.checkpoint.dir``, or a temp folder in local mode.

    On a cluster an unset folder is an error, because a machine-local path is lost with its machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not _is_local(spark):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    fresh = tempfile.mkdtemp(prefix="millrace-")
    spark.sparkContext.setCheckpointDir(fresh)
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below this application's part of the shared folder."""
    return f"{_scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def _scratch_root(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/millrace/{spark.sparkContext.applicationId}"


def drop_scratch(spark: SparkSession) -> bool:
    """Delete what this application froze or wrote to scratch paths. Frames read from there end with it."""
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_scratch_root(spark))
    return root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(root, True)


def scratch_name(label: str) -> str:
    """A fresh name for a view or table."""
    return f"{label}_{uuid.uuid4().hex[:12]}"


def freeze(df: DataFrame) -> DataFrame:
    """Cut lineage by a table in the shared folder, written once and read back.

    A lost executor re-reads these rows instead of recomputing them, and a reader that needs a few of
    the columns reads no others.
    """
    path = scratch_path(df.sparkSession, "frozen")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(scan: DataFrame, *keys: str) -> DataFrame:
    """Repartition a plain scan, but only when it has fewer splits than the cluster has cores.

    Text work costs far more CPU than the scan, so a small file with one split would keep one core busy.
    With more splits than cores, which is every large input, the rows stay where they are.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    if scan.rdd.getNumPartitions() >= cores:
        return scan
    return scan.repartition(cores, *keys)
