"""Session construction and shared-storage locations.

The checkpoint directory is the cluster's shared folder named by
``spark.checkpoint.dir``.  We read it from the session and only set our own
when it is unset (local tests); lineage cuts and scratch tables go below it,
never to a machine-local temp folder.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "reglink") -> SparkSession:
    """Build (or reuse) a session with AQE on and the UI off.

    Cluster settings win: the shuffle partition count is only set when given
    (or ``REGLINK_SHUFFLE_PARTITIONS`` is set, or the master is local), and
    driver memory only for local masters."""
    builder = SparkSession.builder.appName(app_name)
    local = bool(master) and master.startswith("local")
    if master:
        builder = builder.master(master)
    parts = shuffle_partitions or os.environ.get("REGLINK_SHUFFLE_PARTITIONS") or (8 if local else None)
    if parts:
        builder = builder.config("spark.sql.shuffle.partitions", str(parts))
    if local:
        builder = builder.config("spark.driver.memory", os.environ.get("REGLINK_DRIVER_MEMORY", "8g"))
    builder = (
        builder
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # Candidate generation explodes small shuffles (distinct names) 50x
        # downstream; let AQE keep small shuffles spread over the cores.
        # No effect on large data, where partitions are far above this size.
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "16k")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder; create a local one only when unset."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or sc.getConf().get(CHECKPOINT_CONF, None)
    if not current:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder that driver and executors share (master {sc.master})")
        # Local runs and tests only: a cluster names its shared folder itself.
        current = tempfile.mkdtemp(prefix="reglink-ckpt-", dir="/tmp")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(current)
    return sc.getCheckpointDir() or current


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder below the shared checkpoint directory."""
    base = ensure_checkpoint_dir(spark)
    return f"{base.rstrip('/')}/reglink-scratch/{name}-{uuid.uuid4().hex[:12]}"


def stage_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet below the shared checkpoint directory and read it back."""
    path = scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


MANY = 1 << 16      # rows (names, addresses) from which on a side of a join is not sent through the driver


def join_side(df: DataFrame, rows: int | None = None) -> DataFrame:
    """``df`` as a side of a join: sent to the other side where it is counted to be of few rows, else shuffled.

    Spark sizes a scan by its compressed files and an explode by its input: left to that, what counts as 10 MB can be
    many times that as a broadcast, which the driver holds, and AQE doesn't take a broadcast back."""
    return df.hint("broadcast" if rows is not None and rows <= MANY else "merge")
