"""Session helpers: local sessions for tests and bench, and durable scratch.

Library code never creates a session; it takes the caller's. Durable
intermediate tables go under the cluster's ``spark.checkpoint.dir`` (a
shared file system on a cluster). Only a local-mode session without that
setting gets a private temporary folder, as in tests.
"""
from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", partitions: int = 8, app: str = "riskloom") -> SparkSession:
    """Local session for tests and the bench (UI off, AQE on, UTC)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.scheduler.mode", "FAIR")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="riskloom-warehouse-"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the session.

    Reads ``spark.checkpoint.dir`` (or the context's checkpoint dir). Sets a
    private temporary one only for a local-mode session where it is unset.
    """
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # a remote (Connect) session: the server owns the checkpoint folder
        if conf_dir:
            return conf_dir
        raise RuntimeError("spark.checkpoint.dir must be set for a remote session")
    current = sc.getCheckpointDir()
    if current:
        return current
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir() or conf_dir
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="riskloom-ckpt-"))
    return sc.getCheckpointDir()


def durable(df: DataFrame) -> DataFrame:
    """Cut lineage with a reliable checkpoint in the shared checkpoint dir.

    Used where a plan contains a sampling or position-dependent step
    (range partitioning, row positions) whose recomputation after an
    executor loss must see exactly the same rows.
    """
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def write_table(df: DataFrame, name: str, partition_by: list[str] | None = None, options: dict[str, str] | None = None) -> DataFrame:
    """Write ``df`` as parquet under the checkpoint dir and read it back (``options``: of the writer, as a codec for wide texts)."""
    spark = df.sparkSession
    base = checkpoint_dir(spark).rstrip("/")
    path = f"{base}/riskloom-tables/{name}-{uuid.uuid4().hex[:12]}"
    writer = df.write.mode("overwrite").options(**(options or {}))
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return spark.read.parquet(path)
